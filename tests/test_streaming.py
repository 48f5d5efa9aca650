"""Stateless operators give the same rows on a stream as on a table."""

from almoner.operators import quality as D
from almoner.operators import search as Q
from almoner.operators.quality import FieldMeta
from almoner.sources.resources import read_resource
from almoner.streaming import stream_resource


def test_search_and_validation_on_a_stream(spark, rows, tmp_path):
    path = str(tmp_path / "accounts")
    data = [("1", "A", "a@b.org"), ("2", "B", "nope"), ("3", "A", "bad")]
    spark.createDataFrame(data, "accountId string, firstName string, email string").write.json(path)
    meta = [FieldMeta("email", "Email")]

    def work(df):
        request = {
            "searchFields": [{"field": "firstName", "operator": "EQUAL", "value": "A"}],
            "outputFields": ["accountId", "email"],
        }
        return D.validate_fields(Q.search(df, request), meta, "accountId")

    run = work(stream_resource(spark, path, "accounts", "json")).writeStream.format("memory").queryName("issues")
    started = run.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    started.awaitTermination(60)
    assert rows(spark.table("issues")) == rows(work(read_resource(spark, path, "accounts", "json")))
    assert rows(spark.table("issues")) == [("3", "email", "invalid_format", "error")]
