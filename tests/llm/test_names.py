"""Steps that return the caller's table leave columns of any name as they are."""

from jobsignals.llm import mixing, nearcopies, quality, shards

NAMES = ["_row", "_known", "_null", "_turn", "_n", "_score", "_file", "_at", "_position", "_rows", "_before", "_doc_id", "_places",
         "row", "n", "score", "position", "a`b", "given__0", "places__"]


def documents(spark):
    rows = [(i, f"some words of text number {i} and more of them" if i % 3 else None, f"s{i % 2}", *[f"{n}{i}" for n in range(len(NAMES))])
            for i in range(12)]
    rows += [(None, "", None, *["x"] * len(NAMES))]
    names = ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")


def as_rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*["`" + c.replace("`", "``") + "`" for c in columns or df.columns]).collect()), key=str)


def test_columns_come_back_as_they_were(spark):
    docs = documents(spark)
    want = as_rows(docs)
    found = {
        "near copies": nearcopies.one_of_each(docs), "order": mixing.in_mixed_order(docs), "shards": shards.sharded(docs),
        "dealt": shards.dealt(docs), "quality": quality.good(docs, lambda texts: [1.0] * len(texts))}
    for step, df in found.items():
        assert df.columns[: len(docs.columns)] == docs.columns, step
        assert as_rows(df, docs.columns) == want, step


def test_replaced_columns(spark):
    docs = documents(spark).selectExpr("*", "'x' AS shard", "1 AS slot")
    for df in (shards.sharded(docs), shards.dealt(docs)):
        assert sorted(df.columns) == sorted(docs.columns) and {f.dataType.simpleString() for f in df.schema if f.name == "shard"} == {"int"}
