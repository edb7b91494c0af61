import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spinledger.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [2, 300, 32767, 32768, 50257, 2**32 - 1])
def test_round_trip_of_ids(top):
    rng = np.random.default_rng(top)
    lengths = np.array([1, tokens.BLOCK, tokens.BLOCK + 1, 3000, 2])
    ids = rng.integers(0, top, lengths.sum()).astype(np.uint32)
    ids[:700] = 0
    payloads = tokens.packed(ids, lengths)
    back, counts = tokens.unpacked(payloads)
    assert (back == ids).all() and (counts == lengths).all()
    start = lengths[:3].sum()
    for number in range(-(-3000 // tokens.BLOCK)):
        low = start + number * tokens.BLOCK
        want = ids[low : min(low + tokens.BLOCK, start + 3000)]
        assert (tokens.block(payloads[3], number) == want).all()


def test_small_ids_take_little_room():
    ids = np.ones(6000, np.uint32)
    assert len(tokens.packed(ids, np.array([6000]))[0]) < 6000 / 60 * 8 + 300


def test_pieces_encode_like_whole_texts():
    plain = Tokenizer.from_file(PATH)
    texts = [
        "", " ", "a", "a b  c", " lead", "trail ", "tab\t x", "line\nnext line\n\nblank", "\n", "a \n b",
        "don't we'll I'm", "12 34,56 ---- x", "é ü ß   z", "<|endoftext|> in <|endoftext|>",
        "  ".join(["two spaces"] * 3), " \n", "end ", "x\r\ny", "日本語 のテキスト", "a\x1cb c\x1f d", "word,\nword. word;", "'s 't",
    ]
    encoder = tokens.Encoder(PATH)
    for batch in (texts, texts[::-1], [t + " " + t for t in texts]):
        want = [plain.encode(t, add_special_tokens=False).ids for t in batch]
        assert [ids.tolist() for ids in encoder.encode(batch)] == want


def test_long_texts_are_cut_at_safe_places(monkeypatch):
    plain = Tokenizer.from_file(PATH)
    monkeypatch.setattr(tokens, "SEGMENT", 50)
    monkeypatch.setattr(tokens, "SIGNS_HELD", 400)
    encoder = tokens.Encoder(PATH)
    texts = ["word, and  two\nlines. " * 40, "x" * 300, "日本語 " * 90, "", "a b " * 100 + "\n\n"]
    for _ in range(2):
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_full_memory_starts_anew(monkeypatch):
    plain = Tokenizer.from_file(PATH)
    monkeypatch.setattr(tokens, "PIECES_HELD", 32)
    encoder = tokens.Encoder(PATH)
    for n in range(30):
        text = " ".join(f"w{n * k % 37}x{k}" for k in range(20))
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_are_told_apart_by_text():
    plain = Tokenizer.from_file(PATH)
    bits = [n.bit_count() & 1 for n in range(1024)]
    texts = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    encoder = tokens.Encoder(PATH)
    for batch in (texts, [f"x {t} y" for t in texts], texts[::-1]):
        want = [plain.encode(t, add_special_tokens=False).ids for t in batch]
        assert [ids.tolist() for ids in encoder.encode(batch)] == want


def test_files_hold_every_document(odd, none, clashing):
    plain = Tokenizer.from_file(PATH)
    rows = sorted(
        ((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd.collect())
    )
    want, start = [], 0
    for known, doc_id, text in rows:
        ids = [*plain.encode(text, add_special_tokens=False).ids, tokens.END]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        want.append((doc_id if known else None, start, len(ids), crc))
        start += len(ids)
    for docs in (odd, clashing):
        got = [tuple(r) for r in tokens.token_table(docs, PATH).collect()]
        assert sorted(got, key=lambda r: r[1]) == want
    assert tokens.token_table(none, PATH).count() == 0
