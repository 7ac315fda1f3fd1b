"""Link-ranked full-text search over large document corpora, as Spark jobs."""
