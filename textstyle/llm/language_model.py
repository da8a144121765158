"""Complete-document log-likelihood by a gated recurrent language model.

Tokens are words, ASCII letters in lower case, and one end. All training tokens are counted.
The output is factored by classes: a softmax over classes from the state, then a word within
its class. The ``HEAD`` most frequent words stand in classes of neighbouring frequency with a
softmax of their own over the state; all other words form classes by their last two bytes,
and share their class's probability by their counts plus one, one part of it going to what
was never seen. So every token has a probability, and the model starts as the unigram model.

Training is truncated backpropagation in numpy. A bounded warm start in one task, over the
``WARM_DOCS`` training documents with the least hashes of their ids, is followed by one pass
over all training documents in ``SHARES`` rounds: in each, every partition trains on its own
part of the round's share and the parameters are averaged, in a tree.

Scoring runs the documents of a batch in step, in windows that hand their state on, however
long a document is. The most frequent words, ``KNOWN`` at most, are looked up in the task; the counts
of all other words come from a join with the whole vocabulary.

Rows: NULL and empty texts are their end alone. Repeated rows and ids are scored each, and
each counts in training. Without training rows the score is the base score. All columns but
the text pass through, those named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from textstyle.llm.common import arrow_batches, fresh, key_mod, settle

FOLDS, HELD_OUT = 7, 2
# At most KNOWN words are held by every task.
HEAD, HEAD_CLASSES, ENDINGS, KNOWN = 2000, 40, 100, 1 << 17
UNITS = 24
WARM_DOCS, WARM_EPOCHS = 1000, 2
# Rounds of the pass; each reads its own one of this many parts of the training documents.
SHARES = 4
STREAMS, WINDOW, RATE = 48, 20, 0.08
# Documents that are scored in step, and rows of a window whose outputs are worked out at once.
IN_STEP, ROWS = 256, 8192
# Rows that are trained on at once, for the memory of a task.
TRAINED = 1000
# Distinct words that a task counts before it hands them on.
COUNTED = 300_000
END = b""
RESULTS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens(text: str | None) -> list[bytes]:
    # Only ASCII letters change in bytes.lower, only ASCII white space splits bytes.
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def is_held_out(folds: int, held_out: int):
    return key_mod("doc_id", folds) == held_out


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, count) over all rows; every task adds up its own before the shuffle."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counter.update(tokens(text))
                if len(counter) > COUNTED:
                    yield pd.DataFrame({"word": counter.keys(), "n": counter.values()})
                    counter.clear()
        yield pd.DataFrame({"word": counter.keys(), "n": counter.values()})

    return docs.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("count")
    )


@dataclass
class Lexicon:
    """Symbols of the model and the counts of the most frequent words.

    Symbols are the head words, then the classes of endings; the last class takes the rest.
    """

    words: list[bytes]
    counts: np.ndarray
    head: int
    endings: dict[bytes, int]
    class_mass: np.ndarray
    total: int
    distinct: int

    def __post_init__(self):
        head_classes = min(HEAD_CLASSES, max(self.head, 1))
        # Head words by falling count, cut into classes of about equal mass.
        mass = np.cumsum(np.sqrt(self.counts[: self.head]))
        cut = (mass / max(mass[-1] if len(mass) else 1, 1) * head_classes).astype(int)
        self.class_of_head = np.unique(np.minimum(cut, head_classes - 1), return_inverse=True)[1]
        self.head_classes = int(self.class_of_head.max()) + 1 if self.head else 0
        self.starts = np.searchsorted(self.class_of_head, np.arange(self.head_classes + 1))
        self.classes = self.head_classes + len(self.class_mass)
        self.symbols = self.head + len(self.class_mass)
        self.class_of = np.concatenate(
            [self.class_of_head, self.head_classes + np.arange(len(self.class_mass))]
        ).astype(np.int64)
        self.log_count = np.log10(self.counts + 1.0)
        self.symbol_of = np.array(
            [i if i < self.head else self.tail(w) for i, w in enumerate(self.words)], dtype=np.int64
        )
        self.end = self.words.index(END)

    def tail(self, word: bytes) -> int:
        return self.head + self.endings.get(word[-2:], len(self.class_mass) - 1)

    def lookup(self) -> dict[bytes, int]:
        class Places(dict):
            def __missing__(self, word: bytes) -> int:
                return -1

        return Places(zip(self.words, range(len(self.words)), strict=True))

    def read(self, text: str | None, places: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols and places of the tokens (-1: not among the known), and the words there."""
        found = tokens(text)
        place = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
        symbol = self.symbol_of[place]
        rare = np.flatnonzero(place < 0)
        words = [found[i] for i in rare.tolist()]
        if words:
            symbol[rare] = [self.tail(w) for w in words]
        return symbol, place, words


def lexicon(vocabulary: DataFrame) -> Lexicon:
    """Driver-side tables of fixed size: known words, endings, mass of the tail classes."""
    sums = vocabulary.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    # Counts in steps of an eighth of an octave: a few hundred rows however large the corpus,
    # and a limit above which at most KNOWN words lie, so that no task sends its own best ones.
    step = F.floor(F.log2("count") * 8)
    steps = sorted(vocabulary.groupBy(step.alias("step")).count().collect(), reverse=True)
    fits = np.cumsum([r["count"] for r in steps]) <= KNOWN
    least = min((r["step"] for r, fit in zip(steps, fits, strict=True) if fit), default=None)
    listed = vocabulary.filter(step >= least if least is not None else F.length("word") == 0)
    top = sorted(listed.collect(), key=lambda r: (-r["count"], bytes(r["word"])))
    words, counts = [bytes(r["word"]) for r in top], [r["count"] for r in top]
    if END in words:
        # The end is a symbol of its own whatever its count.
        at = words.index(END)
        words.insert(0, words.pop(at))
        counts.insert(0, counts.pop(at))
    else:
        words.insert(0, END)
        counts.insert(0, vocabulary.filter(F.length("word") == 0).first()["count"])
    head = min(HEAD, len(words))
    listed = [F.lit(w) for w in words[:head]]
    tail = vocabulary.filter(~F.col("word").isin(listed)).groupBy(
        F.expr("substring(word, -2)").alias("ending")
    ).agg(F.sum(F.col("count") + 1).alias("mass"))
    rows = tail.orderBy(F.desc("mass"), "ending").limit(ENDINGS).collect()
    endings = {bytes(r["ending"]): i for i, r in enumerate(rows)}
    all_mass = tail.agg(F.sum("mass").alias("m")).first()["m"] or 0
    mass = [r["mass"] for r in rows]
    # One more in each class for words never seen.
    class_mass = np.array([*mass, all_mass - sum(mass)], dtype=np.float64) + 1
    return Lexicon(words, np.array(counts, dtype=np.float64), head, endings, class_mass,
                   sums["n"], sums["v"])


class Model:
    """Gated recurrent units with inputs looked up by symbol and factored outputs."""

    NAMES = ("inputs", "recurrent", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, known: Lexicon, units: int = UNITS, seed: int = 3):
        self.known, self.units = known, units
        random = np.random.default_rng(seed)
        scale = 1 / np.sqrt(units)
        mass = np.concatenate([
            [known.counts[a:b].sum() + (b - a)
             for a, b in zip(known.starts[:-1], known.starts[1:], strict=True)],
            known.class_mass,
        ])
        self.parts = {
            "inputs": random.normal(0, 0.3, (known.symbols, 3 * units)),
            "recurrent": random.normal(0, scale, (units, 3 * units)),
            "to_class": np.zeros((units, known.classes)),
            "class_bias": np.log(mass / mass.sum()),
            "to_word": np.zeros((known.head, units)),
            "word_bias": np.log(known.counts[: known.head] + 1),
        }
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.parts[n].ravel() for n in self.NAMES])

    def load(self, values: np.ndarray) -> Model:
        at = 0
        for name in self.NAMES:
            part = self.parts[name]
            self.parts[name] = values[at : at + part.size].reshape(part.shape).astype(np.float32)
            at += part.size
        return self

    def step(self, state: np.ndarray, symbol: np.ndarray):
        """The next state, and what backpropagation needs: gates, candidate, its recurrence."""
        u = self.units
        given = self.parts["inputs"][symbol]
        back = state @ self.parts["recurrent"]
        # In place where nothing is needed afterwards: the arrays are small and many.
        gates = given[:, : 2 * u] + back[:, : 2 * u]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        update, reset = gates[:, :u], gates[:, u:]
        candidate = reset * back[:, 2 * u :]
        candidate += given[:, 2 * u :]
        np.tanh(candidate, out=candidate)
        following = state - candidate
        following *= update
        following += candidate
        return following, gates, candidate, back[:, 2 * u :]

    def outputs(self, states: np.ndarray, target: np.ndarray, learn: bool = False):
        """Natural log-probability of each target symbol; with ``learn`` also the slopes."""
        p, known = self.parts, self.known
        rows = np.arange(len(target))
        of_class = known.class_of[target]
        logits = states @ p["to_class"] + p["class_bias"]
        logits -= logits.max(axis=1, keepdims=True)
        found = logits[rows, of_class]
        chance = np.exp(logits, out=logits)
        total = chance.sum(axis=1)
        found -= np.log(total)
        grads, back = {}, None
        if learn:
            chance /= total[:, None]
            chance[rows, of_class] -= 1
            grads["to_class"] = states.T @ chance
            grads["class_bias"] = chance.sum(axis=0)
            back = chance @ p["to_class"].T
            grads["to_word"] = np.zeros_like(p["to_word"])
            grads["word_bias"] = np.zeros_like(p["word_bias"])
        order = np.argsort(of_class, kind="stable")
        edges = np.searchsorted(of_class[order], np.arange(known.head_classes + 1))
        for c in range(known.head_classes):
            own = order[edges[c] : edges[c + 1]]
            a, b = known.starts[c], known.starts[c + 1]
            if not len(own) or b - a < 2:
                continue
            words = states[own] @ p["to_word"][a:b].T + p["word_bias"][a:b]
            words -= words.max(axis=1, keepdims=True)
            at = target[own] - a
            own_part = words[np.arange(len(own)), at]
            chance = np.exp(words, out=words)
            total = chance.sum(axis=1)
            found[own] += own_part - np.log(total)
            if learn:
                chance /= total[:, None]
                chance[np.arange(len(own)), at] -= 1
                grads["to_word"][a:b] = chance.T @ states[own]
                grads["word_bias"][a:b] = chance.sum(axis=0)
                back[own] += chance @ p["to_word"][a:b]
        return (found, back, grads) if learn else found


class Trainer:
    """Truncated backpropagation over streams of whole documents, with Adagrad steps."""

    def __init__(self, model: Model, rate: float = RATE):
        self.model, self.rate = model, rate
        self.seen = {k: np.full_like(v, 1e-2) for k, v in model.parts.items()}

    def window(self, state, symbols, targets, opens, full) -> np.ndarray:
        """One window: ``opens`` marks where a document begins and the state is cleared,
        ``full`` where a stream has tokens."""
        model, u = self.model, self.model.units
        kept = []
        for t in range(len(symbols)):
            state = state * ~opens[t][:, None]
            before = state
            state, gates, candidate, back = model.step(state, symbols[t])
            kept.append((before, gates, candidate, back, state))
        on = full.ravel()
        states = np.concatenate([k[4] for k in kept])
        slope = np.zeros_like(states)
        _, slope[on], grads = model.outputs(states[on], targets.ravel()[on], learn=True)
        slope = slope.reshape(len(symbols), -1, u)
        tokens_here = int(on.sum())
        recurrent = model.parts["recurrent"]
        grads["recurrent"] = np.zeros_like(recurrent)
        given = np.empty((len(symbols), symbols.shape[1], 3 * u), np.float32)
        later = np.zeros_like(state)
        for t in range(len(symbols) - 1, -1, -1):
            before, gates, candidate, back, _ = kept[t]
            update, reset = gates[:, :u], gates[:, u:]
            slope_h = slope[t] + later
            d_candidate = slope_h * (1 - update) * (1 - candidate**2)
            given[t, :, :u] = slope_h * (before - candidate) * update * (1 - update)
            given[t, :, u : 2 * u] = d_candidate * back * reset * (1 - reset)
            given[t, :, 2 * u :] = d_candidate
            through = given[t].copy()
            through[:, 2 * u :] *= reset
            grads["recurrent"] += before.T @ through
            later = (slope_h * update + through @ recurrent.T) * ~opens[t][:, None]
        used, place = np.unique(symbols.ravel(), return_inverse=True)
        order = np.argsort(place, kind="stable")
        sums = np.add.reduceat(
            given.reshape(-1, 3 * u)[order], np.searchsorted(place[order], np.arange(len(used)))
        )
        for name, grad in grads.items():
            self._move(name, slice(None), grad / tokens_here)
        self._move("inputs", used, sums / tokens_here)
        return state

    def _move(self, name: str, where, grad: np.ndarray) -> None:
        # Slopes are scaled to a token's share of a usual window.
        grad = np.clip(grad * 30, -1, 1)
        self.seen[name][where] += grad**2
        self.model.parts[name][where] -= self.rate * grad / np.sqrt(self.seen[name][where])

    def learn(self, docs: list[np.ndarray], streams: int = STREAMS, window: int = WINDOW) -> int:
        """One pass over the documents, dealt into streams of about equal length."""
        loads, lists = np.zeros(streams, np.int64), [[] for _ in range(streams)]
        for doc in docs:
            at = int(loads.argmin())
            loads[at] += len(doc)
            lists[at].append(doc)
        lists = [s for s in lists if s]
        if not lists:
            return 0
        length = -(-max(sum(map(len, s)) for s in lists) // window) * window
        end = self.model.known.end
        targets = np.full((length, len(lists)), end, np.int64)
        opens = np.zeros((length, len(lists)), bool)
        full = np.zeros((length, len(lists)), bool)
        for i, stream in enumerate(lists):
            at = 0
            for doc in stream:
                targets[at : at + len(doc), i] = doc
                opens[at, i] = True
                at += len(doc)
            full[:at, i] = True
        symbols = np.roll(targets, 1, axis=0)
        symbols[opens] = end
        state = np.zeros((len(lists), self.model.units), np.float32)
        for t in range(0, length, window):
            state = self.window(state, symbols[t : t + window], targets[t : t + window],
                                opens[t : t + window], full[t : t + window])
        return int(loads.sum())


def likelihoods(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each document's symbols, states carried through it all."""
    result = np.zeros(len(docs))
    by_length = sorted(range(len(docs)), key=lambda d: -len(docs[d]))
    for first in range(0, len(docs), IN_STEP):
        group = by_length[first : first + IN_STEP]
        lengths = np.array([len(docs[d]) for d in group])
        scores = np.zeros(len(group))
        state = np.zeros((len(group), model.units), np.float32)
        symbol = np.full(len(group), model.known.end)
        flat = np.concatenate([docs[d] for d in group])
        starts = np.cumsum(lengths) - lengths
        states, targets, owners, rows = [], [], [], 0
        for t in range(int(lengths[0])):
            on = int(np.searchsorted(-lengths, -t, "left"))
            state, *_ = model.step(state[:on], symbol[:on])
            symbol = flat[starts[:on] + t]
            states.append(state)
            targets.append(symbol)
            owners.append(np.arange(on))
            rows += on
            if rows >= ROWS or t + 1 == lengths[0]:
                found = model.outputs(np.concatenate(states), np.concatenate(targets))
                scores += np.bincount(np.concatenate(owners), found, len(group))
                states, targets, owners, rows = [], [], [], 0
        result[group] = scores
    return result


def train(docs: DataFrame, known: Lexicon) -> np.ndarray:
    """The parameters, after the warm start and the rounds over all shares of the documents."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(known)
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    def learner(start: np.ndarray | None, epochs: int, streams: int):
        def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lexicon_here = sent.value
            places = lexicon_here.lookup()
            model = Model(lexicon_here)
            if start is not None:
                model.load(start)
            trainer, seen = Trainer(model), 0
            for batch in batches:
                texts = [lexicon_here.read(text, places)[0] for text in batch["text"]]
                for _ in range(epochs):
                    seen += trainer.learn(texts, streams)
            if seen:
                yield pd.DataFrame({"model": [model.flat().tobytes()], "seen": [seen]})

        return learn

    # Rows, not ids: an id, or none, may stand at any number of texts.
    tagged = docs.withColumn("tag", F.xxhash64("text"))
    chosen = settle(
        tagged.select(hashed.alias("h"), F.col("doc_id").alias("id"), F.col("tag").alias("of"))
        .orderBy("h", "id", "of").limit(WARM_DOCS).select("id", "of").distinct(), "lm-warm",
    )
    here = tagged["doc_id"].eqNullSafe(chosen["id"]) & (tagged["tag"] == chosen["of"])
    warm = tagged.join(chosen, here, "left_semi").dropDuplicates(["doc_id", "tag"]).select("text")
    schema = "model binary, seen long"
    rows = warm.repartition(1).mapInPandas(learner(None, WARM_EPOCHS, STREAMS), schema).collect()
    values = np.frombuffer(rows[0]["model"], np.float32)
    for number in range(SHARES):
        part = docs.filter(F.pmod(hashed, F.lit(SHARES)) == number).select("text")
        with arrow_batches(docs.sparkSession, TRAINED):
            models = settle(part.mapInPandas(learner(values, 1, STREAMS), schema), "lm-models")
        if not models.limit(1).count():
            continue
        summed = models.rdd.map(
            lambda r: (np.frombuffer(r["model"], np.float32).astype(np.float64) * r["seen"], r["seen"])
        )
        total, seen = summed.treeReduce(lambda x, y: (x[0] + y[0], x[1] + y[1]), depth=3)
        values = (total / seen).astype(np.float32)
    return values


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """Every row with held_out, n_tokens, n_known, train_tokens, base_score and score."""
    own = docs.drop(*RESULTS)
    held = is_held_out(folds, held_out)
    training = own.select("doc_id", "text").filter(~held)
    with arrow_batches(docs.sparkSession, 4000):
        vocabulary = settle(count_tokens(training), "lm-vocabulary")
    if not vocabulary.limit(1).count():
        plain = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1
        return own.select(
            *[c for c in own.columns if c != "text"], held.alias("held_out"), plain.cast("long").alias("n_tokens"),
            F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"),
            F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"),
        )
    known = lexicon(vocabulary)
    values = train(training, known)
    sent = docs.sparkSession.sparkContext.broadcast((known, values))
    # Logarithm of what a tail class shares, by class.
    log_mass = np.log10(known.class_mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon_here, parameters = sent.value
        model, places = Model(lexicon_here).load(parameters), lexicon_here.lookup()
        for batch in batches:
            read = [lexicon_here.read(text, places) for text in batch.column("text").to_pylist()]
            model_score = likelihoods(model, [symbol for symbol, _, _ in read]) / np.log(10)
            n_tokens, n_found, counts, shares = [], [], [], []
            for symbol, place, _ in read:
                there, in_tail = place >= 0, symbol >= lexicon_here.head
                n_tokens.append(len(symbol))
                n_found.append(int(there.sum()))
                counts.append(lexicon_here.log_count[place[there]].sum())
                # What the class's probability is multiplied with, but for rare words' counts.
                shares.append(lexicon_here.log_count[place[there & in_tail]].sum()
                              - log_mass[symbol[in_tail] - lexicon_here.head].sum())
            kept = batch.drop_columns("text")
            found = [pa.array(n_tokens, pa.int64()), pa.array(n_found, pa.int64()),
                     pa.array(counts, pa.float64()), pa.array(shares, pa.float64()),
                     pa.array(model_score, pa.float64()),
                     pa.array([words for _, _, words in read], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(kept.columns + found, kept.schema.names + made)

    # Names of the working columns: none that the table has.
    row, of_row, looked, *made = fresh(
        own, "row", "of_row", "looked", "n_tokens", "n_found", "counts", "shares", "model", "rare"
    )
    n_tokens, n_found, counts, shares, model_part, rare = made
    kept = [f for f in own.schema if f.name != "text"]
    schema = StructType([*kept, StructField(row, LongType()), *[
        StructField(name, kind) for name, kind in zip(made, (
            LongType(), LongType(), DoubleType(), DoubleType(), DoubleType(),
            ArrayType(BinaryType())), strict=True)
    ]])
    with arrow_batches(docs.sparkSession, 4000):
        scored = settle(
            own.withColumn(row, F.monotonically_increasing_id())
            .select(*[f.name for f in kept], row, "text").mapInArrow(run, schema),
            "lm-scored",
        )
    # Words beyond the known ones: a word is below the rank of the known, so no key is hot.
    looked_up = (
        scored.select(F.col(row).alias("of_row"), F.explode(rare).alias("word"))
        .join(vocabulary, "word").groupBy("of_row")
        .agg(F.count("*").alias("found"), F.sum(F.log10(F.col("count") + 1)).alias("logs"))
        .select(F.col("of_row").alias(of_row), F.struct("found", "logs").alias(looked))
    )
    joined = scored.join(looked_up, scored[row] == looked_up[of_row], "left")
    more = F.coalesce(F.col(looked)["found"], F.lit(0))
    logs = F.coalesce(F.col(looked)["logs"], F.lit(0.0))
    return joined.select(
        *[scored[f.name] for f in kept],
        held.alias("held_out"),
        F.col(n_tokens).alias("n_tokens"),
        (F.col(n_found) + more).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col(counts) + logs - F.col(n_tokens) * float(np.log10(known.total + known.distinct + 1)))
        .alias("base_score"),
        (F.col(model_part) + F.col(shares) + logs).alias("score"),
    )
