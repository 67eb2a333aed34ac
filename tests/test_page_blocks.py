"""Blocks of pages, a few pages at a time."""

import pyarrow as pa

from jurispark.plans.wiki import HELD, pieces


def test_a_task_holds_the_blocks_of_few_pages():
    """Blocks of all pages of a batch were held at once: up to 10 000 pages, whatever their length."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array([f"<p>{i}</p>" for i in range(1000)])], names=["page_id", "html"])
    found = [*pieces([batch, batch.slice(0, 0)])]
    assert max(b.num_rows for b in found) <= HELD and [i for b in found for i in b.column(0).to_pylist()] == [*range(1000)]
