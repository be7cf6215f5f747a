"""DataFrame operators: profiling, synchronisation, synonyms, graph, browsing, limits, vocabulary maps."""
