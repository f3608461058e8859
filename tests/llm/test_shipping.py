"""What a worker holds when its task has ended."""

import gc

import psutil

from ledgerline.llm.shipping import _given_back, mapped


def test_free_memory_is_given_back():
    process = psutil.Process()
    blocks = [b"x" * (60_000 + i % 7) for i in range(4_000)]
    kept = blocks[::200]
    del blocks
    gc.collect()
    before = process.memory_info().rss
    _given_back()
    after = process.memory_info().rss
    assert len(kept) == 20 and after < before - 100_000_000


def test_a_task_gives_back_at_its_end(spark):
    """The rows are those of the function, also where its reader stops early."""

    def doubled(batches):
        for batch in batches:
            yield batch
            yield batch

    table = spark.range(10, numPartitions=2)
    assert mapped(table, doubled, table.schema).count() == 20
    assert len(mapped(table, doubled, table.schema).take(3)) == 3
