"""Packing: exact round trip of the ids, little padding, neighbours together."""

from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kerbside.llm import packing

SCHEMA = "doc_id long, text string, start string, order string"


def test_round_trip(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in "kel mor tan vis ruo".split() for b in "da lo ni su pe gra".split()]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 700)))), "x", "y") for i in range(300)]
    rows += [(1000, None, "x", "y"), (1001, "", "x", "y"), (1002, "Ünïcode 😀\r\n\t  two  blanks 　 it's 12345 <|endoftext|> end", "x", "y"),
             (1003, "word " * 30_000, "x", "y"), (1004, "x" * 20_000, "x", "y"), (None, "no id", "x", "y")]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), per_shard=100).collect()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        parts[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in rows:
        got = sorted(parts[doc_id])
        ids = [i for _, part, _ in got for i in part]
        assert ids == [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        assert {n for *_, n in got} == {len(ids)}
        assert [s for s, *_ in got] == np.cumsum([0, *(len(p) for _, p, _ in got)])[:-1].tolist()
    used = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        used += at
    assert used >= 0.97 * 1024 * len(sequences)
    again = packing.pack(spark.createDataFrame(rows, SCHEMA), per_shard=100).count()
    assert again == len(pieces)


def test_neighbours_share_windows():
    rng = np.random.default_rng(4)
    topics = [rng.integers(t * 1000, t * 1000 + 300, (20, 250)) for t in range(10)]
    tails = [t for topic in zip(*topics) for t in topic]  # topics take turns
    windows = packing.packed(tails, 1000)
    pure = sum(len({t % 10 for t, *_ in w}) == 1 for w in windows)
    assert pure >= 0.9 * len(windows)
    assert sorted((t, b + i) for w in windows for t, b, n in w for i in range(n)) == [(t, i) for t in range(200) for i in range(250)]


def test_nothing(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
