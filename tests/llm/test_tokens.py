"""Token store and chat formatting: exact ids, exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from edge import ODD, frame, prose

from tidemark.llm import chat_format as C
from tidemark.llm import tokens as T
from tidemark.llm.common import scratch
from tidemark.llm.token_store import read_store, shuffle_planes, unshuffle_planes, write_store


def ids_of(texts):
    tokenizer = T.load(T.tokenizer_path())[0]
    return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def test_pieces_give_the_ids_of_the_whole():
    rng = random.Random(4)
    letters = ["a", "B", " ", "\n", "é", "'s", "  ", "\t", "!", "12", "<|endoftext|>", "日", "\x1c", "’", "🙂", "\xa0", " "]
    texts = ["".join(rng.choice(letters[:n]) for _ in range(rng.randint(0, 25))) for n in (4, 8, 17) for _ in range(700)]
    got = T.encode_all(T.tokenizer_path(), texts)
    assert got == [x.tobytes() for x in ids_of(texts)]


def test_added_tokens_as_the_library_encodes_them():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(T.tokenizer_path())
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b c", "no such token", "<|endoftext| >"]
    got = [np.frombuffer(x, "<u4").tolist() for x in T.encode_all(T.tokenizer_path(), texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[1] == [plain.token_to_id("<|endoftext|>")]


def test_a_full_cache_is_used_as_it_stands(monkeypatch):
    monkeypatch.setattr(T, "_TOKENIZERS", {})
    monkeypatch.setattr(T, "CACHE", 30)
    texts = [prose(40, i) + "\nend. of line" for i in range(6)]
    got = [x for i in range(0, 6, 2) for x in T.encode_all(T.tokenizer_path(), texts[i:i + 2] + ["one two", ""])]
    assert got == [x.tobytes() for i in range(0, 6, 2) for x in ids_of(texts[i:i + 2] + ["one two", ""])]
    kept = T.load(T.tokenizer_path())[2]
    T.encode_all(T.tokenizer_path(), ["x one two"])
    kept_before = dict(kept)
    T.encode_all(T.tokenizer_path(), [texts[0] + " one two"])
    assert dict(kept) == kept_before and not {"one", "two"} & set(kept.batch), "only unknown pieces are encoded and held beside the cache"


def test_a_word_needs_the_library_once_whatever_stands_behind_it(monkeypatch):
    monkeypatch.setattr(T, "_TOKENIZERS", {})
    T.encode_all(T.tokenizer_path(), ["the kettle. A kettle's lid"])
    texts = ["one kettle, two kettle!! kettle's (kettle) kettle.\nthe lid"]
    assert T.encode_all(T.tokenizer_path(), texts) == [x.tobytes() for x in ids_of(texts)]
    kept = T.load(T.tokenizer_path())[2]
    assert set(kept.batch) == {"!!", "(kettle", ")", ",", "\nthe", "one", "two"}, "only what no text held before"


@pytest.mark.parametrize("cache", [0, 500, 1 << 21])
@pytest.mark.parametrize("crowded", [False, True])
def test_pieces_by_their_bytes(monkeypatch, cache, crowded):
    monkeypatch.setattr(T, "_TOKENIZERS", {})
    monkeypatch.setattr(T, "CACHE", cache)
    monkeypatch.setattr(T, "BLOCK", 70)  # a text of many pieces is looked up in parts
    if crowded:  # every piece starts on one of four slots
        monkeypatch.setattr(T.Pieces, "_home", lambda self, low, high: (low & np.uint64(3)).astype(np.int64))
    rng = random.Random(6)
    sizes = [1, 2, 6, 7, 8, 9, 13, 14, 15, 16, 63, 64, 200]
    ends = ["", "\0", "\0\0", ".", ",", "'s", "'S", "!?", "é.", "1.5", "_x", "-\t-", "日", "\x7f"]
    words = ["".join(rng.choice("abé7") for _ in range(rng.choice(sizes))) + rng.choice(ends) for _ in range(1500)]
    texts = [rng.choice(["", " ", "\n", "."]) + rng.choice([" ", "\n"]).join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(300)]
    want = [x.tobytes() for x in ids_of(texts)]
    got = [x for i in range(0, 300, 5) for x in T.encode_all(T.tokenizer_path(), texts[i:i + 5])]
    assert got == want and T.encode_all(T.tokenizer_path(), texts) == want
    kept = dict(T.load(T.tokenizer_path())[2])
    pieces = [p.decode() for p in kept]
    assert len(kept) <= cache and [kept[p.encode()] for p in pieces] == [x.tobytes() for x in ids_of(pieces)]
    assert bool(kept) == bool(cache)


def test_many_pieces_are_found_again_and_stay_small(monkeypatch):
    monkeypatch.setattr(T, "_TOKENIZERS", {})
    texts = [" ".join(f"w{i:x}" for i in range(a, a + 20_000)) for a in range(0, 100_000, 20_000)]
    first = [T.encode_all(T.tokenizer_path(), [t])[0] for t in texts]
    kept = T.load(T.tokenizer_path())[2]
    assert len(kept) == 100_000 and not kept.long
    assert kept.slots.nbytes + kept.ids.nbytes < 100 * len(kept)
    assert T.encode_all(T.tokenizer_path(), texts) == first == [x.tobytes() for x in ids_of(texts)] and not kept.batch


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    ids = np.random.default_rng(1).integers(0, 2**32, 1001, dtype=np.uint64).astype("<u4")
    for part in (ids, ids[:1], ids[:64]):
        assert (unshuffle_planes(shuffle_planes(part, kind), len(part)) == part).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_store_round_trip(spark, kind):
    docs = [r[:2] for r in ODD] + [(100 + i, prose(40 + i, i)) for i in range(50)] + [(99, prose(60000, 9))]
    path = scratch(spark, "store")
    write_store(frame(spark, docs), path, kind=kind)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_store(spark, path).collect())
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    start, want = 0, []
    for (i, _), ids in zip(ordered, ids_of(t or "" for _, t in ordered), strict=True):
        ids = np.append(ids, 2).astype("<u4")
        want.append((start, i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    chunks = spark.read.parquet(path)
    assert chunks.where("n_ids > 65536").count() == 0 and chunks.agg({"n_ids": "sum"}).first()[0] == start


def test_empty_store(spark):
    path = scratch(spark, "store")
    write_store(frame(spark, []), path)
    assert read_store(spark, path).count() == 0


def test_escape_is_reversible():
    for text in ["<|im_end|>\n", "<\\|x", "</s>[INST] ok [/INST]", "<\\\\|im_start|>", "[\\INST]<", "<<SYS>>", "a<", "\\", "%0A", ""]:
        assert C.unescape(C.escape(text)) == text
        assert "<|" not in C.escape(text) and "[INST]" not in C.escape(text)
        formatted, _ = C.render([("user", text), (f"a%0A\n{text}", text)])
        assert C.parse(formatted) == [("user", text), (f"a%0A\n{text}", text)]


def test_masked_tokens_by_binary_search():
    offsets = np.array([(0, 2), (3, 5), (5, 6), (5, 6), (6, 9)])  # a trimmed blank at 2, a character of two tokens
    mask, covered = C.masked_tokens(offsets, [(2, 4), (5, 6)])
    assert mask.tolist() == [False, True, True, True, False] and covered == [(2, 4), (5, 6)]
    assert C.masked_tokens(offsets[:0], [(0, 0)])[1] == []


def test_conversations(spark):
    probe = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", probe), (1, 2, "user", None), (1, 3, "assistant", " leading\n\nand é🙂 日本 "),
            (2, None, None, "x"), (2, 0, "assistant", ""), (None, 5, "assistant", "lost"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a")]
    rows += [(7, t, "assistant" if t % 2 else "user", f"turn {t} {probe}") for t in range(1500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    formatted = C.format_conversations(df).cache()
    got = {r.conv_id: r for r in C.conversation_digests(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, role or "", text or "") for c, t, role, text in rows if c == conv), key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        parts = sorted((r.part, r.seq, r.formatted, r.ids) for r in formatted.where(
            formatted.conv_id.eqNullSafe(conv)).collect())
        whole = "".join(p[2] for p in parts)
        assert g.formatted_chars == len(whole)
        assert [i for p in parts for i in p[3]] == ids_of([whole])[0].tolist(), "runs encode as the whole would"
    assert formatted.where("conv_id = 7").count() > 1
    assert C.conversation_digests(C.format_conversations(df.limit(0))).count() == 0
