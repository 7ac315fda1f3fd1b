"""Jobs over documents, links, ranks, words and keyed tables."""
