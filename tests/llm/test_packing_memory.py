"""What a task of the tokeniser holds."""

import public_tokenizers
import pyarrow as pa
import tokenizers

from strandforge.llm import packing, queries


def test_few_rows_at_a_time_and_no_words_kept():
    texts = [f"word{i} wörd{i * 7919}, and\nline  {i}<|endoftext|> x " for i in range(2_000)] + [None, "", " ", "\n\n", "a  b\t c"]
    rows = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc", "text"])
    parts = list(packing._tokenise(queries.ranks_path(), 0)(iter([rows])))
    assert max(p.num_rows for p in parts) <= 256
    got = [i for p in parts for i in p.column("ids").to_pylist()]
    told = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, got, strict=True):
        want = told.encode(text or "", add_special_tokens=False).ids + [0]
        assert pa.array(want, pa.uint16()).buffers()[1].to_pybytes()[:2 * len(want)] == ids
    held = packing.encoder(queries.ranks_path())
    assert not isinstance(held, dict) and all(len(v) < 100 for v in vars(held).values() if isinstance(v, (dict, list)))
