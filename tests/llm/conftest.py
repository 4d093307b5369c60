import duckdb
import pyarrow as pa
import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, kept string, score string, size int, comp string, digest int"
)
PARAGRAPH = " ".join(f"word{i} {'abcdefghij'[i % 10] * 3}" for i in range(60))
EDITED = PARAGRAPH.replace("word30", "other30")


def edge_rows():
    long_text = "\n".join(f"line {i} of the very long text, number {i * 7919 % 10007}" for i in range(4000))
    texts = [
        (1, PARAGRAPH, "en", "a"),
        (2, PARAGRAPH.upper(), "en", "a"),
        (2, PARAGRAPH.upper(), "en", "a"),  # a repeated row
        (3, EDITED, "en", None),
        (4, None, None, "b"),
        (5, "", "de", "b"),
        (6, " \t\n\x0b\x0c\r ", "de", "b"),
        (7, "one", "fr", "c"),
        (8, "one two", "fr", "c"),
        (None, "no id here at all", None, None),
        (None, None, None, None),
        (9, long_text, "en", "a"),
        (10, long_text + "\nlast line", "en", "a"),
        (11, "first\nsame a\nsame b\nsame c\nend\n", "en", "d"),
        (12, "other\nsame a\nsame b\nsame c\n\nsame a\nsame b\nsame c", "en", "d"),
        (13, "x" * 700, "en", "d"),
        (14, "é ñ 你好 ÀÉ", "es", "é"),
    ]
    return [(*t, len(t[1]) if t[1] else None, "r", "k", "s", 1, "c", 2) for t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    from larder.llm.tables import ship_package

    ship_package(spark)
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    from larder.llm.tables import ship_package

    ship_package(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture
def by_sql():
    """Rows of a DuckDB query over a table ``documents`` of Python rows."""

    def run(sql, rows):
        con = duckdb.connect()
        ids, texts = zip(*[(r[0], r[1]) for r in rows], strict=True)
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
        con.register("documents", table)
        answer = con.sql(sql)
        return sorted((dict(zip(answer.columns, r, strict=True)) for r in answer.fetchall()), key=repr)

    return run
