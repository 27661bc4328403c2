"""The data model in docflow.schemas is what the functions produce."""


from docflow import schemas as SC
from docflow.functions.paths import page_parts
from docflow.operators.latest import index_record
from docflow.sinks import tables as K
from docflow.sources.files import parse_block_xml, parse_meta


def _shape(t):
    return [(f.name, f.dataType.simpleString()) for f in t.fields]


def test_meta_and_blocks(spark):
    df = spark.createDataFrame([("0 1.5 jp 3 1 True", "<D><Title><RawString>t</RawString></Title></D>")],
                               "m string, x string")
    out = df.select(parse_meta("m").alias("meta"), parse_block_xml("x").alias("blocks"))
    assert _shape(out.schema["meta"].dataType) == _shape(SC.META)
    assert _shape(out.schema["blocks"].dataType) == _shape(SC.BLOCKS)


def test_index_record(spark):
    df = spark.createDataFrame([("/r/jp/ja_translated/s/n/2024/01/09-10-00/p.txt", "text", "http://u")],
                               "p string, t string, u string")
    out = df.select(index_record("t", page_parts("p", "/r"), "u").alias("rec"))
    assert _shape(out.schema["rec"].dataType) == _shape(SC.INDEX_RECORD)


def test_ledger(spark, scratch):
    df = spark.createDataFrame([("p1", 0)], "page_path string, status int")
    K.append_ledger(df, f"{scratch}/led", "extract")
    got = spark.read.parquet(f"{scratch}/led").select(*[f.name for f in SC.LEDGER.fields])
    assert _shape(got.schema) == _shape(SC.LEDGER)
