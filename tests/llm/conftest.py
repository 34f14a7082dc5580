import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = "/root/testdata/sf0.01"
# Columns whose names the operators use themselves.
CLASHES = ("id key n kind bucket start size mark token tokens score label asked pivot piece copies slot value "
           "__id __key __spans own_id own_key own_id_ own_spans hash fp cell word form rank number block").split()


@pytest.fixture(scope="session")
def frame(spark):
    """A frame of documents from (doc_id, text) pairs, with further columns of clashing names."""
    def build(rows, id_type="bigint"):
        df = spark.createDataFrame(rows, f"doc_id {id_type}, text string").repartition(3)
        extra = [f"'{name}' as `{name}`" for name in CLASHES]
        return df.selectExpr("*", *extra, "cast(null as string) as lang", "'s' as source", "cast(null as bigint) as n_chars")
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ids that are shared, characters of all sizes."""
    story = " ".join(f"word{i % 977} goes" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d"), (7, "é ü ß 漢字 😀 ñ"),
        (8, story), (9, story + " end"), (9, "other text under a shared id"), (10, "x" * 70_000),
        (None, "a row without id"), (None, None), (11, "tail.\n"), (12, "\u0000\u0001 control \x85 \xa0 marks"),
    ]
