import pytest

#: Columns that operators might use as names of their own.
CLASHING = ["score", "line", "key", "a", "b", "grp", "name", "rid", "h", "stats", "__row_", "cid", "n", "thash", "shard", "bucket", "home"]

LONG = " ".join(f"word{i % 977}x{i}" for i in range(6000)) + " " + "z" * 70_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank and very long texts, ties, repeated rows, clashing columns."""
    base = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix a potion of nine rare herbs today"
    rows = [(1, base, "en", "s", 5), (2, base, "en", None, None), (3, base.replace("nine", "ten"), None, "s", 1), (4, None, "en", "s", 0),
            (5, "", "en", "s", 0), (6, " \n\t ", "en", "s", 4), (7, LONG, "de", "s", 9), (8, LONG, "de", "s", 9), (9, "one", None, None, None),
            (9, "one", None, None, None), (None, "no id at all here but a text", "en", "s", 3), (None, None, None, None, None),
            (10, "mail bob.smith@example.org or call +1 (212) 555-0199 from 10.1.2.3 card 4111 1111 1111 1111", "en", "s", 2),
            (11, "a\n\nb\nThe same line of text, which comes again\nb", "en", "s", 1), (12, "The same line of text, which comes again!\n中文中文中文", "en", "s", 1),
            (13, "▁ 😀 é ́ <|endoftext|> it's 12", "en", "s", 1)]
    extra = {c: f"x{i}" for i, c in enumerate(CLASHING)}
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
    df = spark.createDataFrame([(*r, *extra.values()) for r in rows], schema)
    return df


@pytest.fixture(scope="session")
def odd_files(spark, odd_docs, tmp_path_factory):
    """The odd table as a data folder, with labels."""
    d = str(tmp_path_factory.mktemp("odd"))
    odd_docs.coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (3, 0, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    odd_pages(spark).coalesce(1).write.parquet(f"{d}/pages.parquet")
    odd_vectors(spark).coalesce(1).write.parquet(f"{d}/embeddings.parquet")
    return d


def odd_pages(spark):
    """Null ids, urls and texts, short and long equal texts, repeated rows, a url with line breaks, clashing columns."""
    long, copied = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 9000, "<html>" + "copy " * 40
    rows = [(1, "http://a.example/", copied), (2, "http://b.example/ä b\r\nX: 1", copied), (2, "http://b.example/ä b\r\nX: 1", copied), (None, None, copied),
            (3, None, None), (4, "http://c.example/", ""), (5, "http://d.example/", "short"), (6, "http://d.example/", "short"), (7, "http://e.example/", long),
            (8, "http://f.example/", "y" * 99), (9, "http://f.example/", "y" * 99), (10, "http://g.example/", "z" * 100), (11, "http://g.example/", "z" * 100),
            (12, "http://h.example/", "w" * 200), (12, "http://h.example/", "w" * 200), (None, "http://i.example/", "v" * 150), (None, None, "v" * 150), (13, "", long)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id bigint, url string, html string, place string, digest string, shard string")


def odd_vectors(spark):
    """Null vectors, null and non-finite entries, other lengths, huge and tied entries, repeated rows."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]),
            (None, [-3.0, 2.5, 0.75]), (7, []), (8, [1.0]), (9, [1e4, -1e4, 0.0]), (10, [0.0, 0.0, 0.0])]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, n string, component int")


@pytest.fixture(scope="session")
def empty_files(spark, odd_docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    odd_docs.limit(0).write.parquet(f"{d}/documents.parquet")
    odd_pages(spark).limit(0).write.parquet(f"{d}/pages.parquet")
    odd_vectors(spark).limit(0).write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the smallest driver table, by id."""
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
