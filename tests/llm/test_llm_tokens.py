"""Byte-pair codec, packing and chat formatting."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from helpers import SF, docs_of, with_clashes
from tokenizers import Tokenizer

from cohortine.llm import chat, packing
from cohortine.llm.base import read
from cohortine.llm.bytepair import PerfectHash, codec, encode_documents, read_ranks

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def truth():
    lines = map(bytes.split, open(RANKS, "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash():
    for n in (0, 1, 2, 7, 3000):
        keys = [f"k{i}".encode() for i in range(n)]
        table = PerfectHash(keys)
        assert table.find(keys) == list(range(n))
        assert sorted(table.index.tolist()) == list(range(n))
        assert table.find([b"", b"other"]) == [-1, -1]


def test_codec_equals_the_library(truth):
    tool = codec(read_ranks(RANKS), P.PATTERN)
    rng = random.Random(5)
    parts = ["the", " und", "  ", "\n", "12345", "é", "日本語", "\U0001f600", "'s", "a" * 300, "!?", "\t", "x" * 7]
    texts = ["", " ", "a" * 20_000, " " * 500 + "x", "<|endoftext|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    for text, (ids, said) in zip(texts, tool.encode(texts)):
        assert ids.tolist() == truth.encode_ordinary(text)
        assert said == ",".join(map(str, ids))
        assert tool.decode(ids) == text.encode()


def test_codec_query(spark, truth):
    docs = read(spark, SF, "documents").limit(60)
    extra = docs_of(spark, [(-1, None), (-2, ""), (None, "x"), (-3, "y"), (-3, "y")])
    both = docs.unionByName(extra)
    got = encode_documents(with_clashes(both), RANKS, P.PATTERN).collect()
    texts = defaultdict(list)
    for r in both.collect():
        texts[r.doc_id].append(r.text or "")
    assert len(got) == both.count()
    for r in got:
        ids = truth.encode_ordinary(texts[r.doc_id][0])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id][0].encode()).hexdigest()
    assert encode_documents(docs_of(spark, []), RANKS, P.PATTERN).count() == 0


def test_windows_are_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        capacity = 8
        places = [0]
        while len(places) < rng.randint(2, 12):
            places.append(places[-1] + rng.randint(1, capacity))
        penalties = [0.0] + [float(rng.choice([0, 1, 3])) for _ in places[1:]]
        path, cost = packing.cut_windows(places, penalties, capacity)
        best = [0.0] + [float("inf")] * (len(places) - 1)
        for k in range(1, len(places)):
            best[k] = min(
                best[i] + capacity - (places[k] - places[i]) + penalties[k]
                for i in range(k)
                if places[k] - places[i] <= capacity
            )
        assert cost == best[-1] and path[0] == 0 and path[-1] == len(places) - 1
        lengths = np.diff([places[i] for i in path])
        assert lengths.max() <= capacity
        assert cost == sum(capacity - lengths) + sum(penalties[i] for i in path[1:])


def check_packing(rows, documents, capacity):
    """Every id in one piece, sequences gapless and in order; returns the padding share."""
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    copies = defaultdict(int)
    for doc, text in documents:
        copies[doc] += 1
    assert set(by_doc) == set(copies)
    for doc, text in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        covered = np.zeros(len(ids), int)
        for r in by_doc[doc]:
            part = ids[r.start : r.start + r.length]
            assert r.length > 0 and len(part) == r.length and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            covered[r.start : r.start + r.length] += 1
        assert (covered == copies[doc]).all()
    padding = tokens = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= capacity
        tokens += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / tokens


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_packing_whole_table(spark, block):
    docs = read(spark, SF, "documents")
    extra = [(-1, None), (-2, ""), (-3, "twice"), (-3, "twice"), (-4, "<|endoftext|> A'S É! x\u00a0y"), (None, "z")]
    both = docs.unionByName(docs_of(spark, extra))
    got = packing.pack_documents(
        with_clashes(both), WORDS, 1024, block_tokens=block, with_ids=False
    ).collect()
    documents = [(r.doc_id, r.text) for r in both.collect()]
    assert check_packing(got, documents, 1024) < 0.03


def test_packing_small_cases(spark):
    assert packing.pack_documents(docs_of(spark, []), WORDS).count() == 0
    one = packing.pack_documents(docs_of(spark, [(1, None)]), WORDS).collect()
    assert [(r.start, r.length, r.doc_tokens, r.offset, r.ids) for r in one] == [(0, 1, 1, 0, [2])]
    # No sentence end for thousands of words.
    many = [(1, "word " * 9000)]
    got = packing.pack_documents(docs_of(spark, many), WORDS, with_ids=False).collect()
    assert check_packing(got, many, 4096) < 0.01
    with pytest.raises(ValueError):
        packing.pack_documents(docs_of(spark, many), WORDS, 1000)


def test_chat_round_trip():
    template = chat.ChatTemplate()
    rng = random.Random(1)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", " ", "é", "\n", "[ROLE]", "TEXT]"]
    names = ["user", "assistant", "system", "tool", "", "x\n[TEXT] y", "[INST]", "us\\er"]
    for _ in range(500):
        roles = [rng.choice(names) for _ in range(rng.randint(1, 6))]
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in roles]
        column = pa.array(["zz<", *texts, "[INST]"])[1:-1]
        out, ends, spans = chat.assemble(
            template, [r.encode() for r in roles], *chat._buffers(column)
        )
        raw = out.tobytes()
        want = [(r.encode(), t.encode()) for r, t in zip(roles, texts)]
        assert list(chat.read_turns(template, raw)) == want and ends[-1] == len(raw)
        for (a, b), text in zip(spans, texts):
            assert template.unescape(raw[a:b]) == text.encode()
            assert not any(mark in raw[a:b] for mark in template.controls())


def test_chat_table(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i} </s>") for i in range(700)]
    rows += [(2, 0, None, None), (2, 1, "assistant", None), (3, 5, "assistant", "ü"), (3, 5, "assistant", "ü")]
    rows += [(None, 0, "system", "[INST]"), (4, None, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {
        r.conv_id: r
        for r in chat.conversation_digests(chat.format_conversations(with_clashes(turns))).collect()
    }
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        mine = sorted(
            ((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        said = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        learned = "".join(text for _, role, text in mine if role == "assistant")
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.loss_chars == len(learned)
    chunks = chat.format_conversations(turns).where("conv_id = 1").orderBy("chunk").collect()
    assert len(chunks) > 1 and sum(c.n_turns for c in chunks) == 700
    assert got[1].formatted_chars == sum(len(c.formatted) for c in chunks)
    assert chat.format_conversations(turns.limit(0)).count() == 0
