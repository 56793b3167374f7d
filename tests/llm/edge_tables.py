"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, size int, shard int, word string, run int, start int"
LONG = " ".join(f"word{i % 977} and{i % 31} tail{i}" for i in range(30_000))
PASSAGE = "The committee met on a grey morning to weigh the costs of the bridge, and nobody in the hall spoke for some minutes afterwards. "


def edge_rows():
    texts = [
        (1, "The same text, twice.", "en", "a"), (2, "The same text,  twice. ", "en", "a"), (3, "Thesametext,twice.", "en", "b"), (4, None, "en", "a"),
        (5, "", None, "b"), (6, " \t\n\x0b\f\r", "fr", None), (7, "  ", "fr", None), (8, "Ünïcode straße \U0001f600 naïve", "de", "ü"),
        (9, LONG, "en", "a"), (10, LONG + " more", "en", "b"), (11, PASSAGE * 3, "en", "c"), (12, "Before it. " + PASSAGE + PASSAGE, "en", "c"),
        (13, "one", "en", "c"), (14, "one two", "en", "c"), (15, "one two three", "en", "c"), (16, "ONE two Three", "en", "c"),
        (17, "a\x00b null byte", "en", "d"), (18, "x " * 400, "en", "d"), (18, "x " * 400, "en", "d"), (None, "no id here", "en", "d"),
        (None, "no id here", "en", "d"), (20, "1234 !!! ???", "en", None), (21, "　", "es", "z"), (22, "y" * 5000, "es", "z"),
    ]
    return [(*row, len(row[1]) if row[1] is not None else None, "clash", 7, 7, "w", 1, 2) for row in texts]


def edge_documents(spark, rows=True):
    return spark.createDataFrame(edge_rows() if rows else [], SCHEMA)


def write_edge_documents(spark, folder, rows=True):
    edge_documents(spark, rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
