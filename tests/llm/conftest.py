import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CLASHING = ["id", "t1", "t2", "node", "key", "n", "a", "b", "score", "kept", "component_id", "n_links", "spans", "place", "hits", "item",
            "text_", "piece_key", "removed", "predicted", "host", "wrapper", "__t1_"]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of the smallest table with edge rows and columns of clashing names."""
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first = base.orderBy("doc_id").first()["text"]
    other = base.where("length(text) > 400").orderBy("doc_id").first()["text"]
    words = other.split(" ")
    rows = [(None, first), (None, None), (900001, None), (900002, ""), (900003, " \n\t "), (900004, "one"), (900005, "one two"),
            (900004, "one"), (900004, "one"), (0, first), (900006, "A a a a a a"), (900007, "a " * 3000), (900008, "x" * 20000),
            (900009, " ".join(words[:-1])), (900010, " ".join([*words[:20], "zebra", *words[21:]])),
            (900011, "\n".join(f"This is the line number {i} of a form that is sent again and again" for i in range(6))),
            (900012, "日本語 テスト 😀 é " * 30), (900013, other.upper()), (900014, "\n\n" + other + "\n" + first)]
    out = base.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    return out.withColumns({x: F.lit(None).cast("string") for x in CLASHING}).repartition(4).cache()


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")
