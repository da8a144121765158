"""DataFrame -> DataFrame operators. All are lazy: none starts a job or caches."""
