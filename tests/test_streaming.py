from lexspark.sources.io import ATTESTATION
from lexspark.streaming.incremental import match_stream

SCHEMA = f"evidence_id string, {ATTESTATION}"


def test_batches_match_what_arrives(spark, tmp_path):
    concepts = spark.createDataFrame([("c1", "Left Hand"), ("c2", "foot")], "concept_id string, name string")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    row = lambda e, name: (e, "S", "1", None, None, None, (name, []), None, None, name, None, None, None, None, None, [], None)
    stream = lambda: match_stream(spark.readStream.schema(SCHEMA).json(src), concepts, out, str(tmp_path / "ck")).awaitTermination()
    spark.createDataFrame([row("e1", "left hand"), row("e2", "nose")], SCHEMA).write.json(src)
    stream()
    spark.createDataFrame([row("e3", "fóot")], SCHEMA).write.mode("append").json(src)
    stream()
    got = {(r.concept_id, r.evidence_id, tuple(r.reasons)) for r in spark.read.parquet(out).collect()}
    assert got == {("c1", "e1", ("exact",)), ("c2", "e3", ("normalised",))}
