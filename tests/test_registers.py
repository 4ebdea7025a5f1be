"""Registers over jamo on literal sentences."""

import pytest
from pyspark.sql import functions as F

from weftline.operators.registers import composed, rewritten_speech, split_jamo
from weftline.plans.registers import FORMAL, MILITARY, POLITE


@pytest.mark.parametrize(
    ("text", "polite", "formal", "military"),
    [
        ("먹어.", "먹어요.", "먹습니다.", "먹슴다."),
        ("밥 먹어? 응 있어!", "밥 먹어요? 응 있어요!", "밥 먹습니까? 응 있습니다!", "밥 먹슴까? 응 있슴다!"),
        ("추워", "추워요", "춥습니다", "춥슴다"),
        ("고마워요~", "고마워요~", "고맙습니다~", "고맙슴다~"),
        ("들어", "들어요", None, None),
        ("말해?!", "말해요?!", "말합니까?!", "말함까?!"),
        ("그렇지", "그렇죠", "그렇지요", None),
        ("가자. 먹어.", None, None, None),
        ("...", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
        ("plain", None, None, None),
    ],
)
def test_chain(spark, text, polite, formal, military):
    pieces, _ = rewritten_speech(F.col("t"), [])
    df = spark.createDataFrame([(text,)], "t string").withColumn("pieces", pieces)
    made = [rewritten_speech(F.col("t"), chain)[1] for chain in ([POLITE], [POLITE, FORMAL], [POLITE, FORMAL, MILITARY])]
    assert tuple(df.select(*[c.alias(n) for c, n in zip(made, "pfm", strict=True)]).first()) == (polite, formal, military)


def test_jamo_and_back(spark):
    text = "".join(chr(c) for c in range(0xAC00, 0xD7A4)) + " é日 a"
    row = spark.createDataFrame([(text,)], "t string").select(split_jamo(F.col("t")).alias("s"), composed(split_jamo(F.col("t"))).alias("c")).first()
    assert row["c"] == text and len(row["s"]) > 2 * len(text)
