import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import data
from sheetrecon.llm import byte_bpe, id_files, warc

ENCODING = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=byte_bpe.read_ranks(byte_bpe.RANKS), special_tokens={})


def odd_texts():
    r = random.Random(6)
    alphabet = "abIΣ \n\t'sé　.,\x85日本😀1٣!#\x1c\x1f\r  "
    return ["", " ", "<|endoftext|>", "a" * 5000, " " * 3000, "日" * 2000, "́x ́y"] + \
        ["".join(r.choices(alphabet, k=r.randint(0, 40))) for _ in range(4000)]


def test_ids_are_those_of_tiktoken():
    coder = byte_bpe.Codec(byte_bpe.RANKS)
    texts = odd_texts()
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == ENCODING.encode_ordinary(text)
        assert coder.decode(ids.tolist()) == text.encode()


def test_offsets_cover_split_characters():
    coder = byte_bpe.Codec(byte_bpe.RANKS)
    text = "é日😀 𒀀x"
    [ids] = coder.encode([text])
    starts, chars = coder.offsets(text.encode(), ids)
    pieces = [coder.token_bytes[i] for i in ids]
    assert starts == [len(b"".join(pieces[:k])) for k in range(len(pieces))]
    assert chars == [len(text.encode()[:s].decode(errors="ignore")) if text.encode()[s] & 0xC0 != 0x80 else
                     len(text.encode()[:s].decode(errors="ignore")) for s in starts]


def test_digests_and_round_trip(spark):
    rows, docs = data.corpus(spark, 40)
    got = Counter(tuple(r) for r in byte_bpe.token_digests(docs).collect())
    want = Counter()
    for i, t in rows:
        ids = ENCODING.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    back = byte_bpe.decoded(byte_bpe.encoded(docs, with_offsets=True)).select("text", "decoded", "tokens").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert byte_bpe.token_digests(data.documents(spark, [])).count() == 0


def test_word_ids_are_those_of_the_library():
    coder = id_files.WordEncoder(id_files.TOKENIZER)
    model = Tokenizer.from_file(id_files.TOKENIZER)
    texts = odd_texts() + ["<|endoftext|>", "a <|endoftext|>b <|startoftext|>.", "<|ENDOFTEXT|> X", "<|end", "x<|endoftext|"]
    want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode([t.encode() for t in texts])] == want


def test_id_files(spark, tmpdir_path):
    rows, docs = data.corpus(spark, 40)
    path = os.path.join(tmpdir_path, "ids")
    got = id_files.id_files(docs, path=path).collect()
    model = Tokenizer.from_file(id_files.TOKENIZER)
    want = Counter()
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [id_files.END_ID]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert {r.doc_id for r in id_files.read_ids(spark, path, [12, 1003]).collect()} == {12, 1003}
    assert id_files.id_files(data.documents(spark, [])).count() == 0


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ("name", "payload", "digest", "kind", "holder", "bundle")})


def test_archives_round_trip(spark, tmpdir_path):
    big, other = "<p>é\r\n\r\nWARC/1.1 " * 90, "x" * 1000
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, big), (4, "u\r\nv", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "u", other), (None, "u", other), (9, "u", "x" * 999), (10, "u", "x" * 999),
            (3, "again", big), (None, "u", "y" * 1200), (None, "v", "y" * 1200), (11, "u", "z" * 700_000)]
    got = Counter(tuple(r) for r in warc.archive_round_trip(pages(spark, rows).repartition(3)).collect())
    want = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        ids = [j for j, _, h in rows if h == html and j is not None]
        revisit = len(payload) >= 1000 and bool(ids) and i != max(ids)
        want[i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
             max(ids) if revisit else None] += 1
    assert got == want
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_records_are_found_by_frame_and_offset(spark, tmpdir_path):
    rows = [(i, f"http://x/{i}", f"page {i} " * 3000) for i in range(60)]
    manifest = warc.write_archives(pages(spark, rows).repartition(2), os.path.join(tmpdir_path, "w")).collect()
    assert len(manifest) == 60 and max(r.frame for r in manifest) > 1
    for r in manifest[::7]:
        headers, payload, _ = warc.read_record(r.bundle, r.frame_at, r.frame_bytes, r.at, r.bytes)
        assert payload.decode() == rows[int(r.record)][2]
        assert headers["WARC-Target-URI"] == rows[int(r.record)][1]
        assert (r.frame, r.frame_at, r.frame_bytes) in [x[:3] for x in warc.seek_table(r.bundle)]
