from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from linefold.llm.textstats import repeated_words, word_counts


def brute_repeats(words, window):
    runs = [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]
    times = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(window)})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(2, 9))
def test_repeated_words(words, window):
    assert repeated_words(words, window) == brute_repeats(words, window)


def test_word_counts():
    assert word_counts(None) == word_counts(b"") == (0, 0, 0, 0, 0, 0)
    assert word_counts(b" \n\t\x0b\x0c\r ") == (0, 0, 0, 0, 0, 0)
    text = "é b #x|<\n\nab cd\nab cd\n ab cd".encode()
    # a no-break space is part of a word; equal lines are equal byte for byte
    assert word_counts(text) == (8, 19, 3, 1, 0, 4)
