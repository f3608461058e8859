"""Filings arriving in rounds give what one batch gives."""

import pytest

from ledgerline.operators.eligible import eligible_rows
from ledgerline.operators.holdings import holdings
from ledgerline.sources.filings import read_lines
from ledgerline.streaming.arrivals import (
    arriving_long_lines, arriving_texts, ingest, lines_of_blocks, lines_of_texts,
)


def filing(i):
    return "".join(f"APPLE {i}{j}   COM  037833100   {i}   {j} {'CALL' if j % 3 == 0 else ''}\n" for j in range(i))


@pytest.mark.parametrize("long", [False, True])
def test_rounds_equal_batch(spark, tmp_path, long):
    keys = spark.createDataFrame([("037833",)], "key string").cache()
    raw, out, state = tmp_path / "raw", tmp_path / "out", tmp_path / "state"
    (raw / "rawdata_2001_QTR1").mkdir(parents=True)
    path = f"{raw}/*/*.txt"

    def build(batch):
        return holdings(eligible_rows(lines_of_blocks(batch) if long else lines_of_texts(batch), keys))

    for round_ in range(3):
        for i in range(round_ * 3 + 1, round_ * 3 + 4):
            (raw / "rawdata_2001_QTR1" / f"{i}_2001-02-03_{i}.txt").write_text(filing(i))
        for _ in range(2):
            if long:
                arrivals = arriving_long_lines(spark, path, 0)
            else:
                arrivals = arriving_texts(spark, path, maxFilesPerTrigger=2)
            ingest(arrivals, build, str(out), str(state))
    want = holdings(eligible_rows(read_lines(spark, path), keys))
    got = spark.read.parquet(str(out)).drop("batch_id")
    assert got.count() == sum(range(1, 10))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
