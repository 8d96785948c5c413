"""The streaming spend pivot equals the batch pivot over the same files."""
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from creditlens.operators.rollup import period_pivot
from creditlens.sources import roles
from creditlens.sources.tables import Tables
from creditlens.streaming import start_spend_pivot


def test_stream_matches_batch(spark):
    t = Tables(spark, SF_SMALL)
    tx = roles.transactions(t)
    d = tempfile.mkdtemp(prefix="creditlens-stream-")
    tx.write.mode("overwrite").parquet(f"{d}/in")
    seen = {}

    def sink(batch, _id):
        for r in batch.collect():
            seen[r["current_account_nbr"]] = r.asDict()

    q = start_spend_pivot(spark, f"{d}/in", tx.schema, sink, f"{d}/ckpt", trigger_once=True)
    q.awaitTermination()
    batch = {r["current_account_nbr"]: r.asDict() for r in period_pivot(tx).collect()}
    assert seen.keys() == batch.keys()
    for k, row in batch.items():
        for c, v in row.items():
            assert float(seen[k][c]) == float(v), (k, c)
