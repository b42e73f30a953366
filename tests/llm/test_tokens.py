from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelake.llm import packing, tables, token_files, tokens

KINDS = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}


@pytest.fixture(scope="module", params=KINDS)
def encoder(request):
    return tokens.Encoder(tokens.vocabulary(KINDS[request.param]), request.param)


def by_library(kind):
    """The contract's plain call on a fresh tokenizer, which shares nothing with the module's."""
    tokenizer = Tokenizer.from_file(tokens.vocabulary(KINDS[kind]))
    return lambda text: np.array(tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def test_special_names_are_one_id(encoder):
    library = by_library(encoder.kind)
    names = [t.content for t in encoder.tokenizer.get_added_tokens_decoder().values()]
    assert names
    texts = ["hi <|endoftext|> there", "<|endoftext|>", "a<|endoftext|>b", "x <| endoftext |>", "<|", "a <|endoftex",
             *names, *[n.upper() for n in names], *[f"one {n}{n} two\n{n}" for n in names], "plain text",
             "中文 <|startoftext|> été", " <|endoftext|>  <|endoftext|> "]
    texts = [t.encode() for t in texts]
    assert encoder.encode(texts) == [library(t) for t in texts]
    assert encoder.encode(texts) == [library(t) for t in texts]         # from the cache


def test_cache_gives_the_ids_of_whole_texts(encoder, docs):
    library = by_library(encoder.kind)
    texts = [(r["text"] or "").encode() for r in docs.select("text").collect()]
    rng = random.Random(5)
    parts = ["a", "b", "the", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "é", "É", "ß", "×",
             "…", "'s", "don't", "'", "!", "&&&", "12", "3", " ", "　", "中", "Σ", "é",
             "<|endoftext|>", ".", "A", "\x1c", "\x00", "\U0001f642", "ﬁ", "İ", "x" * 90]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(25))).encode() for _ in range(3000)]
    for at in range(0, len(texts), 500):
        assert encoder.encode(texts[at:at + 500]) == list(map(library, texts[at:at + 500]))


def test_small_cache_is_emptied_not_wrong(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 5)
    library = by_library(encoder.kind)
    texts = [f"word{chr(97 + k % 26)} alpha beta {k}, gamma".encode() for k in range(40)]
    for at in range(0, 40, 3):
        assert encoder.encode(texts[at:at + 3]) == list(map(library, texts[at:at + 3]))
    assert len(encoder.cache) <= 40


def test_full_cache_keeps_the_pieces_in_use(encoder):
    """Words of every text are encoded once, however often the rare ones fill the cache."""
    own = tokens.Encoder(tokens.vocabulary(KINDS[encoder.kind]), encoder.kind, 200)
    library, asked, plainly = by_library(encoder.kind), [], own.encode_piece
    own.cache.encode = lambda piece: asked.append(piece) or plainly(piece)
    for n in range(60):
        rare = ["".join(chr(97 + int(d)) for d in str(10_000 + 20 * n + k)) for k in range(20)]
        text = f"Common words stay here {' '.join(rare)} été".encode()
        assert own.encode([text]) == [library(text)]
        assert len(own.cache) + len(own.cache.old) <= 200
    assert sum(b"words" in p for p in asked) == 1


def test_all_letters_of_byte_words_have_the_ids_of_the_library(encoder):
    library = by_library(encoder.kind)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    pieces = [(blank + a + b + "n").encode() for blank in ("", " ") for a in letters for b in letters]
    assert encoder.encode(pieces) == [library(p) for p in pieces]


def expected(rows, kind, end):
    """doc_id -> start, ids by the library alone, documents in order."""
    encode = by_library(kind)
    at, out = 0, []
    for doc, text in rows:
        ids = np.append(np.frombuffer(encode((text or "").encode()), "<u4"), end).astype("<u4")
        out.append((doc, at, ids))
        at += len(ids)
    return out


def test_token_files_round_trip(spark, docs):
    path = tables.scratch_path(spark, "test")
    token_files.write_ordered(docs, path, tokens.vocabulary(KINDS["word"]), "word", 2)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in token_files.digests(spark, path).collect()}
    assert len(got) == len(rows)
    for doc, start, ids in expected(rows, "word", 2):
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.data))
    stored = token_files.read(spark, path).orderBy("shard", "before").collect()
    assert [r["doc_id"] for r in stored] == [d for d, _ in rows]


def test_file_layout(spark, docs):
    path = tables.scratch_path(spark, "test")
    token_files.write_ordered(docs, path, tokens.vocabulary(KINDS["word"]), "word", 2)
    name = next(r["f"] for r in token_files.read(spark, path).select(F.input_file_name().alias("f")).collect())
    meta = pq.ParquetFile(name.removeprefix("file://")).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema.split(".")[0]: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["tokens"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index for c in columns.values())
    plan = token_files.read(spark, path, "doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in plan.split("ReadSchema")[1].split("\n")[0].replace("n_tokens", "")


def test_token_files_special_cases(spark, odd, nothing):
    path = tables.scratch_path(spark, "test")
    token_files.write_ordered(odd, path, tokens.vocabulary(KINDS["word"]), "word", 2)
    rows = token_files.digests(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, None, 1, 2, 4, 5, 6, 6, 7, 8]
    assert [r["start"] for r in rows] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in rows])[:-1])).tolist()
    assert rows[2]["n_tokens"] == 1 and rows[5]["n_tokens"] == 40_001
    path = tables.scratch_path(spark, "test")
    token_files.write_ordered(nothing, path, tokens.vocabulary(KINDS["word"]), "word", 2)
    assert token_files.digests(spark, path).count() == 0


def check_packing(rows, texts, length=packing.LENGTH):
    """Pieces lie gapless in full sequences and give every document whole."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for sequence, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == length or sequence == max(by_sequence) and at <= length
        last = at if sequence == max(by_sequence) else length
        pad = 0 if last == length or last & (last - 1) == 0 else length - last
        assert {r["padding"] for r in pieces} == {pad}
    for doc, _, ids in expected(texts, "byte", 1):
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            piece = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.data))
            at += r["length"]
        assert at == len(ids)


def test_packing_round_trip(docs):
    pieces = packing.pack(docs.repartition(5), tokens.vocabulary(KINDS["byte"]), "byte", 1, with_ids=True)
    rows = pieces.collect()
    check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert all(zlib.crc32(np.array(r["ids"], "<u4").data) == r["ids_crc32"] for r in rows)
    whole = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == packing.LENGTH for r in whole if r["padding"] == 0 and r["sequence_id"] < len(whole) - 1)


def test_packing_special_cases(odd, nothing):
    name = tokens.vocabulary(KINDS["byte"])
    rows = packing.pack(odd, name, "byte", 1).collect()
    assert sum(r["doc_id"] == 5 for r in rows) >= 20
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 2
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack(nothing, name, "byte", 1).count() == 0
    assert [packing.padding(n, 8) for n in (0, 1, 2, 3, 4, 5, 7, 8, 11, 12)] == [0, 0, 0, 5, 0, 3, 1, 0, 5, 0]
