"""Memory that hashing and fitting take for each byte of text."""

import tracemalloc

import numpy as np

from tastegrid.llm import hashing, lm, toxicity


def texts(n):
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, size, np.uint8)).decode() for size in rng.integers(2, 9, 20000)]
    return [" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(n)]


def arrays(rows):
    encoded = [r.encode() for r in rows]
    return np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)])


def peak(monkeypatch, run, size):
    monkeypatch.setattr(hashing, "_powers", [np.ones(1, np.uint64)] * 2)  # a worker's tables count as well
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / size
    finally:
        tracemalloc.stop()


def test_words_hash_alike_in_stretches():
    data, offsets = arrays(["", "a bc  def", "x" * 50 + " y", " ", *texts(3)])
    starts, ends, _ = hashing.word_spans(data, offsets, hashing.WHITE)
    short = np.minimum(starts + 3, ends)
    sums = hashing.prefix_sums(data)
    for stretch in (1, 7, 64, 1 << 19):
        found = hashing.span_hashes(data, starts, ends, short, stretch=stretch)
        assert (found == [hashing.span_hash(sums, starts, ends), hashing.span_hash(sums, starts, short)]).all()
    none = np.zeros(0, np.int64)
    assert hashing.span_hashes(np.zeros(0, np.uint8), none, none).shape == (1, 0)


def test_language_model_tokens_take_no_prefix_sums_of_a_whole_chunk(monkeypatch):
    data, offsets = arrays(texts(2500))
    assert peak(monkeypatch, lambda: lm.tokens(data, offsets), len(data)) < 20


def test_toxicity_fit_holds_counts_and_no_pairs_of_feature_and_document(monkeypatch):
    data, offsets = arrays(texts(2500))
    monkeypatch.setattr(toxicity, "STEPS", 2)
    toxic = (np.arange(2500) % 7 == 0).astype(np.int64)
    assert peak(monkeypatch, lambda: toxicity.fit_arrays(data, offsets, toxic), len(data)) < 40
