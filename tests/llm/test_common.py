import pyarrow as pa

from tests.llm.helpers import write_docs
from veracorp.llm import common as C


def sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})


def test_batches_on_their_way_to_python_are_bounded_by_bytes(spark, tmp_path):
    sf = write_docs(spark, tmp_path, [(i, "long text " * 20000) for i in range(120)])
    got = C.documents(spark, sf).coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 120
    assert max(r["size"] for r in got) <= 2 * C.BATCH_BYTES       # one row more than the bound at most
