"""Sources of streamed queries: which rows and files make a batch, and in which order."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from tidewire.plans import live, oracles
from tidewire.spec import SEQUENCE
from tidewire.workspace import names_in

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_a_batch_of_several_csv_files_keeps_their_order(spark, con):
    """Files of one folder are written at once, so the order of their times says nothing."""
    path = live.landed_csv(spark, SF, most=50)
    parts = names_in(spark, path)
    csv = [[n for n in names_in(spark, f"{path}/{part}") if n.endswith(".csv")] for part in parts]
    assert len(parts) == 5 and {len(names) for names in csv} == {4}
    assert live.files_at_once(spark, path) == 4
    run = live.streamed_run(spark, path)
    assert run.samples(spark).filter("stage = 'raw'").count() == 5
    sql = oracles.oracle_sql()
    assert differences(run.table(spark, "clean").drop("verified"), con, sql["stream_add_sequence"]) == ""
    assert differences(run.table(spark, "quarantine"), con, sql["stream_end_to_end_quarantine"]) == ""
    assert differences(run.table(spark, "processed"), con, sql["stream_end_to_end"]) == ""


def test_many_files_make_five_batches_at_most(spark, folder):
    path = folder("many")
    rows = spark.range(0, 240, 1, 12).select(
        F.lit("x").alias("entity"), F.lit("7").alias("epoch"), F.lit("1.5").alias("reading"), F.lit("no").alias("signature")
    )
    rows.write.csv(f"{path}/part=0", header=True)
    run = live.streamed_run(spark, path)
    sizes = [r["size"] for r in run.samples(spark).filter("stage = 'raw'").collect()]
    assert len(sizes) == 4 and sum(sizes) == 240


def test_a_batch_of_several_landed_files_has_all_of_its_numbers(spark, folder):
    rows = live.numbered_signals(spark, SF)
    seen = []
    stream = live.landing(spark, rows, most=50).withColumn("file", F.input_file_name())

    def note(batch, _):
        found = batch.select("file", SEQUENCE).collect()
        seen.append((len({r[0] for r in found}), sorted(r[1] for r in found)))

    live.ended(stream.writeStream.foreachBatch(note).option("checkpointLocation", folder("cp")).trigger(availableNow=True).start())
    assert [files for files, _ in seen] == [4] * 5
    assert [numbers for _, numbers in seen] == [sorted(n for n in range(1, rows.count() + 1) if n % 5 == part) for part in range(5)]
