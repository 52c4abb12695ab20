import pyarrow as pa
import numpy as np

from campaignlens.llm import textops
from tests.llm.helpers import words

TEXTS = ["a b  c\n d", None, "", "xyz", " \n\n", "A b c d e f g\n", "xyz", "été \U0001f642"]


def test_words_and_lines_match_plain_python():
    raw, offsets = textops.text_buffers(pa.array(TEXTS))
    h, starts, ends, at = textops.word_spans(raw, offsets)
    cuts, line_at = textops.line_bounds(raw, offsets)
    for i, text in enumerate(TEXTS):
        found = [bytes(raw[s:e]).decode() for s, e in zip(starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]])]
        assert found == words(text)
        parts = [bytes(raw[cuts[k]:cuts[k + 1]]).decode() for k in range(line_at[i], line_at[i + 1])]
        assert "".join(parts) == (text or "") and len(parts) == (text or "").count("\n") + 1
    assert h[at[3]] == h[at[6]] and len(np.unique(h)) < len(h)


def test_lower_case_is_ascii_only():
    raw, offsets = textops.text_buffers(pa.array(["ABC", "abc", "É", "é"]))
    h, *_ = textops.word_spans(raw, offsets, lower=True)
    assert h[0] == h[1] and h[2] != h[3]


def test_long_text_is_hashed_in_pieces_like_a_short_one(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(3000)) + "x" * 500
    raw, offsets = textops.text_buffers(pa.array([text]))
    whole = textops.word_spans(raw, offsets)
    monkeypatch.setattr(textops, "BLOCK_BYTES", 64)
    pieces = textops.word_spans(raw, offsets)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces))


def test_sliced_columns_and_windows():
    column = pa.array(["skip me", "a b c d e f", "a b", "", "a b c d e f"]).slice(1)
    raw, offsets = textops.text_buffers(column)
    h, _, _, at = textops.word_spans(raw, offsets)
    windows, owner = textops.window_hashes(h, at, 5)
    distinct, ends = textops.distinct_by_row(windows, owner, 4)
    assert np.diff(ends).tolist() == [2, 1, 0, 2]
    assert np.array_equal(distinct[ends[0]:ends[1]], distinct[ends[3]:ends[4]])
