import public_tokenizers

from hitscope.llm import byte_bpe


def test_a_worker_keeps_no_words_after_a_task():
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with byte_bpe.learning(*args) as vocab:
        ids = vocab.encode(["some words and other words"])
        assert vocab.known and vocab.chunks
    assert not vocab.known and not vocab.chunks
    with byte_bpe.learning(*args) as again:
        assert again is vocab and again.encode(["some words and other words"]) == ids


def test_language_states_of_one_direction_are_kept():
    """Peak of what a slice of text takes: the states of both directions alone were 2 * STRETCH * 32 bytes a stretch."""
    import tracemalloc

    import numpy as np

    from hitscope.llm import language_id

    net = language_id.new_network(list("abcd"), 8, np.random.default_rng(0))
    data = np.random.default_rng(1).integers(0, 256, 1 << 19).astype(np.uint8)
    tracemalloc.start()
    try:
        language_id.document_probabilities(net, data, np.array([0, 1 << 18, 1 << 19]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * 32 * len(data)
