"""Small documents that every operator must survive."""

ROWS = [
    (1, "one two three four five six seven eight"),
    (2, "one two  three\tfour five six seven eight"),
    (3, ""),
    (4, None),
    (5, "   \n"),
    (6, "Straße 😀 naïve"),
    (7, "long " * 60_000),
    (8, "one two three four five six seven eight"),
    (8, "one two three four five six seven eight"),
    (None, "nobody's text"),
    (None, None),
    (9, "<|endoftext|> token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" x"),
]
SCHEMA = "doc_id bigint, text string"
#: Names that operators use inside.
CLASHES = "_id _text _key _tag fp sketch leaf length piece ids_crc32 host template found _found _redacted component_id score kept".split()


def documents(spark, rows=None):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("other") for c in CLASHES}).repartition(3)


def empty(spark):
    return documents(spark, [])
