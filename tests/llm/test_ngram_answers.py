"""What keeps the time of op10 in line with distinct n-grams, not with the chunks that have them."""

import numpy as np
import pyarrow as pa

from placeloom.llm import ngram


class Given:
    """Stands for a table; gives back what is run over its batches."""

    def repartition(self, *_):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, _):
        return run


def test_a_shard_looks_up_each_distinct_pair_once(monkeypatch):
    asked, lookup = [], ngram.NgramTrie.lookup
    monkeypatch.setattr(ngram.NgramTrie, "lookup", lambda self, rank, found, size, successor: asked.append(len(successor)) or lookup(self, rank, found, size, successor))
    run = ngram._answer_grams(Given(), 2, 8, {}, 20, 100)
    context, size = np.array([3, 5], np.uint64), np.array([2, 1], np.uint32)
    word, seen, none = np.array([7, 9, 8], np.uint32), np.array([2, 1, 0], np.uint32), np.zeros(3, np.uint32)
    rows = [(0, chunk, ngram.pack(context, True), ngram.pack(size), ngram.pack(word), ngram.pack(c)) for chunk, c in ((1, seen), (2, none), (3, seen))]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    batch = ngram._pack_rows(rows, [(str(i), k) for i, k in enumerate(kinds)])
    got = [r for b in run(iter([batch])) for r in b.to_pylist() if r["chunk"] is not None]
    assert sum(asked) == 3 and [r["chunk"] for r in got] == [1, 2, 3]
    for r in got:  # counts are 4, 2 and 0 in all; the context 5 is unseen
        code, backoff = ngram.unpack(r["code"], np.uint16), ngram.unpack(r["backoff"], np.uint16)
        assert code.tolist() == [*ngram.quantise((np.array([4, 2]) - ngram.DISCOUNT) / 6).tolist(), 0]
        assert backoff.tolist() == [int(ngram.quantise(np.array([ngram.DISCOUNT * 2 / 6]))[0]), 65535]
