"""Exact ids: against two independent encoders, and round trips."""

from __future__ import annotations

import base64

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from roundmill.llm import tokens

RANKS = tokens.read_ranks(tokens.VOCABULARY)
ENCODER = tokens.PrefixEncoder(RANKS)
BYTES = {i: t for t, i in RANKS.items()}


def plain_bpe(data: bytes) -> list[int]:
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((RANKS.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [RANKS[p] for p in parts]


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40) | st.text("aeiounrst lh-_=.0123\n ", max_size=60))
def test_equals_merging_and_round_trip(text):
    for piece in regex.findall(tokens.PATTERN, text):
        data = piece.encode()
        got = ENCODER.encode(data)
        assert got == plain_bpe(data) and b"".join(BYTES[i] for i in got) == data


def test_operator(rows):
    tiktoken = pytest.importorskip("tiktoken")
    other = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    texts = ["The firm's round, 2025.\n\n  Next", "", None, "   ", "नमस्ते दुनिया 😀", "<|endoftext|>", "ab" * 40_000, "x", "x"]
    df = rows("doc_id long, text string, ids string, lang string", *[(i, t, "clash", None) for i, t in enumerate(texts)])
    got = tokens.encode_texts(df)
    assert got.columns == ["doc_id", "ids"]
    for r in got.collect():
        assert r["ids"] == (other.encode_ordinary(texts[r["doc_id"]]) if texts[r["doc_id"]] else [])
    assert tokens.encode_texts(df.limit(0)).count() == 0


def test_read_ranks(tmp_path):
    path = tmp_path / "v"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n\n" + base64.b64encode(b"ab") + b" 1\n")
    assert tokens.read_ranks(str(path)) == {b"a": 0, b"ab": 1}
