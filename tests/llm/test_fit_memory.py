"""Memory of the toxicity fit."""

import tracemalloc

from strandforge.llm import toxicity


def test_a_fit_keeps_numbers_of_words_not_words():
    texts = [" ".join(f"word{(i * 7 + k) % 500}" for k in range(2000)) for i in range(200)]
    tracemalloc.start()
    model = toxicity.fit(texts, [i % 2 for i in range(200)], epochs=0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.vocabulary) == 500 and peak < 12e6  # 400,000 words
