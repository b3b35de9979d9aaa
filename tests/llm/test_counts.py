"""Counts above 2^32."""

from __future__ import annotations

import numpy as np

from warcloom.llm import op02_weighted_minhash, op04_hidden_markov, rounds


def test_document_counts_do_not_wrap():
    hashes = np.array([5, 9], np.uint64)
    asked = [(p, 0, rounds.pack(rounds.narrow(np.array([4_000_000_000, 1])), *rounds.squeeze(hashes, 5))) for p in range(2)]
    for _, _, data in op02_weighted_minhash._frequency(asked):
        assert rounds.unpack(data)[0].tolist() == [8_000_000_000, 2]


def test_word_counts_do_not_wrap():
    hashes, classes = np.array([5, 9], np.uint64), np.zeros(2, np.uint16)
    asked = [(p, 0, rounds.pack(rounds.narrow(np.array([4_000_000_000, 1])), classes, *rounds.squeeze(hashes))) for p in range(2)]
    back = [rounds.unpack(data)[0].tolist() for part, _, data in op04_hidden_markov._count(asked) if part >= 0]
    assert back == [[8_000_000_000, 2]] * 2


def test_narrow():
    assert rounds.narrow(np.array([1, 2])).dtype == np.uint32 and rounds.narrow(np.zeros(0, np.int64)).dtype == np.uint32
    assert rounds.narrow(np.array([1 << 40])).tolist() == [1 << 40]
