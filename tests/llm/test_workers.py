from __future__ import annotations

import pyarrow as pa

from tallyworks.llm import encoding, workers
from tallyworks.llm.queries import TOKENIZER


def test_tasks_forget_what_others_encoded():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], ["x"])
    known = encoding.encoder(TOKENIZER)
    assert list(workers.lean(iter, encodes=True)([batch])) == [batch]
    assert encoding.encoder(TOKENIZER) is known
    assert list(workers.lean(iter)([batch])) == [batch]
    assert encoding.encoder(TOKENIZER) is not known
    table = pa.table({"x": [1]})
    assert workers.lean(lambda t: t)(table) is table
