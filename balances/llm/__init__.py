"""Training-data operators: ten numbered operators over ``documents``,
``pages``, ``benchmark`` and ``labels``. Nothing outside this package imports
it; ``registry`` lists its queries and SQL."""
