from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import orc
from tokenizers import Tokenizer

from rinse.llm import queries, token_orc
from rinse.llm.bytewords import text_slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "a  b", "\n\n x\n", "don't 'tis ''s \"'s 's's", " a", "a ", "  ", "x   b", "12a3 4,5'6's", "日本 語",
    "a\r\n\r\nb\t\tc \t d", "é÷×ñ'll", "<|endoftext|> a<|endoftext|>", "\x1c a\x1cb", "m²3 ½x", "\x85 x", "\xa0  b", "x\xa0  y",
]


def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def by_units(texts):
    encoder = token_orc.Encoder(PATH)
    out = []
    for _, _, data, offsets in text_slices(pa.array(texts)):
        flat, counts = encoder.encode(data, offsets)
        out += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    return out


def test_units_give_the_tokenizers_ids():
    rng, encode = random.Random(5), plain()
    texts = ODD + ["".join(rng.choice("ab1 ',\n\té.s²") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert by_units(texts) == [encode(x) for x in texts]


def test_added_tokens_are_single_ids():
    rng, untouched = random.Random(6), Tokenizer.from_file(PATH)
    pieces = ["<|endoftext|>", "<|endo", "ftext|>", "<|", "a", " b", "1", " ", "\n", "'s", "é", "日"]
    texts = ODD + ["<|endo", "ftext|>", "", "<|endoftext|>"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    assert by_units(texts) == [untouched.encode(x, add_special_tokens=False).ids for x in texts]
    assert by_units(["a<|endoftext|> b"])[0].count(50256) == 1


def test_added_tokens_are_stored(spark, tmp_path):
    untouched = Tokenizer.from_file(PATH)
    texts = ["plain", "<|endoftext|> a<|endoftext|>", None, "<|endo ftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    token_orc.write_tokens(docs, str(tmp_path / "out"), PATH, parts=2)
    stored = {r.doc_id: r.ids for r in token_orc.read_tokens(spark, str(tmp_path / "out")).collect()}
    assert stored == {i: [*untouched.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_round_trip(spark, tmp_path):
    encode = plain()
    rows = [(i * 7 % 31, text) for i, text in enumerate(ODD)] + [(3, None), (3, "same"), (3, "same"), (None, "lost"), (40, "long text " * 50_000)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, part string, start int")
    folder = str(tmp_path / "out")
    token_orc.write_tokens(docs, folder, PATH, parts=4)
    found = token_orc.token_index(spark, folder).collect()
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()))
    want, start = [], 0
    for doc, text in ordered:
        ids = [*encode(text or ""), 0]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted([tuple(x)[:4] for x in found], key=repr) == sorted(want, key=repr)


def test_files_have_stripes_and_blooms(spark, tmp_path):
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text")
    folder = tmp_path / "out"
    token_orc.write_tokens(docs, str(folder), PATH, parts=2)
    files = sorted(folder.glob("*.orc"))
    assert len(files) == 2
    ids = [orc.ORCFile(f).read(["doc_id"]).column(0).to_pylist() for f in files]
    assert [*ids[0], *ids[1]] == list(range(5000))
    plan = token_orc.read_tokens(spark, str(folder)).where("doc_id = 77").select("ids")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in plan
    assert any(b"doc_id" in f.read_bytes() for f in files)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    token_orc.write_tokens(docs, str(tmp_path / "out"), PATH, parts=2)
    assert token_orc.token_index(spark, str(tmp_path / "out")).count() == 0


def test_query(spark):
    found = queries.QUERIES["op1_token_orc"](spark, "/root/testdata/sf0.001")
    rows = found.orderBy("start").collect()
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    encode = plain()
    want = {d.doc_id: np.array([*encode(d.text), 0], dtype="<u4") for d in docs}
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in rows} == {k: (len(v), zlib.crc32(v.tobytes())) for k, v in want.items()}


def test_units_of_equal_sums_are_told_apart():
    thue_morse = lambda n, other: "".join("ab"[(bin(i).count("1") + other) % 2] for i in range(n))
    texts = [thue_morse(n, k) for n in (8, 15, 16, 17, 1024, 2048) for k in range(2)] + ["a\0", "a", "a\0\0", "\0" * 8, "\0" * 7]
    encode = plain()
    assert by_units(texts) == [encode(x) for x in texts]
    encoder = token_orc.Encoder(PATH)
    encoder._find = lambda keys: (np.zeros(len(keys), dtype=np.int64), np.ones(len(keys), dtype=bool))  # every key is taken for the first
    for _, _, data, offsets in text_slices(pa.array(["some other text"])):
        encoder.keys, encoder.front, encoder.back = (np.zeros(1, np.uint64) for _ in range(3))
        flat, _ = encoder.encode(data, offsets)
        assert flat.tolist() == encode("some other text")


def test_what_an_encoder_remembers_is_bounded():
    encode, encoder = plain(), token_orc.Encoder(PATH)
    for k in range(14):
        texts = [" ".join(f"u{i}" for i in range(50_000 * k, 50_000 * (k + 1))) + " often often"]
        for _, _, data, offsets in text_slices(pa.array(texts)):
            flat, counts = encoder.encode(data, offsets)
            assert flat[:2000].tolist() == encode(texts[0][:20_000])[:2000] and counts.sum() == len(flat)
        encoder.tidy()
    held = sum(x.nbytes for x in vars(encoder).values() if isinstance(x, np.ndarray))
    assert len(encoder.keys) < 600_000 and held < 40e6
    # What is met again and again stays, with its ids.
    raw = np.frombuffer(b" often", dtype=np.uint8)
    assert len(encoder.keys) and encoder.encode(raw, np.array([0, 6]))[0].tolist() == encode(" often")


def test_units_that_are_met_again_stay(monkeypatch):
    monkeypatch.setattr(token_orc, "_REMEMBERED", 200)
    rng, encode, encoder = random.Random(8), plain(), token_orc.Encoder(PATH)
    often = [f"often{i}" for i in range(60)]
    for k in range(40):
        text = " ".join(rng.sample(often, 60) + [f"once{k}x{i}" for i in range(20)])
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        flat, _ = encoder.encode(data, np.array([0, len(data)]))
        assert flat.tolist() == encode(text)
        encoder.tidy()
        assert len(encoder.keys) <= 200 and len(encoder.ids) == encoder.n.sum()
        assert k < 2 or len(encoder.keys) >= 60


def test_the_sessions_batch_size_comes_back(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(2500)], "doc_id bigint, text string")
    token_orc.write_tokens(docs, str(tmp_path / "tokens"), PATH, parts=1)
    assert spark.conf.get(name) == before
    got = token_orc.token_index(spark, str(tmp_path / "tokens")).orderBy("doc_id").collect()
    sizes = [r.n_tokens for r in got]
    assert [r.doc_id for r in got] == list(range(2500)) and [r.start for r in got] == [sum(sizes[:k]) for k in range(2500)]
