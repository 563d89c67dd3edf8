import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hazeframe.llm.token_output import Encoder, Reader, read_tokens, token_digests, write_tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["Été, THE the. Ünï... ßẞ İ ΑΣ ΑΣ. ﬁ. a.b c,, 한국 각 ǅ, ٣. x² K Å.", "", None, " ", "\n\n a\tb\x1cc d  e", "Straße É é ́x", "<|endoftext|> it's 12,345###", "x" * 3000, "the of and " * 4000]


def plain(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize(("path", "by_word"), [(WORDS, True), (BYTES, False)])
def test_encoder_equals_whole_text_encoding(path, by_word):
    encoder = Encoder(open(path).read())
    assert encoder.by_word is by_word
    texts = [t or "" for t in ODD]
    got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(texts) + encoder.encode(texts)]
    assert [[*x, 2] for x in got] == plain(path, texts) * 2


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_every_letter_before_a_stop(path):
    """Some letters become a mark when they are lower-cased or composed, which joins a stop behind them."""
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    texts = [f"{w}{stop}" for stop in ",." for c in letters for w in (c, f"ev{c}")]
    texts.append("YEN\u0130, evet EV\u0130. a\u0958, b\u09dc. \u0a33,")
    encoder, tokenizer = Encoder(open(path).read()), Tokenizer.from_file(path)
    joined = [" ".join(texts[at : at + 50]) for at in range(0, len(texts), 50)]
    got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(joined)]
    assert got == [x.ids for x in tokenizer.encode_batch(joined, add_special_tokens=False)]
    if path == WORDS:
        assert encoder.core.fullmatch("Straßenäöüéèà") and not encoder.core.fullmatch("\u0130")


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr("hazeframe.llm.token_output.KNOWN_BYTES", 2000)
    encoder = Encoder(open(WORDS).read())
    texts = [f"word{k} and, other{k % 7} w\u00f6rter{k}." for k in range(200)]
    got = [np.frombuffer(encoder.encode([t])[0], encoder.width).tolist() for t in texts * 2]
    assert [[*x, 2] for x in got] == plain(WORDS, texts * 2)


def expected(rows, path=WORDS):
    ids = plain(path, [t for _, t in rows])
    starts = [0, *accumulate(map(len, ids))]
    return [(k, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (k, _), s, x in zip(rows, starts, ids)]


def test_round_trip(spark):
    rows = [(3 * k, t) for k, t in enumerate(ODD * 3)]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").withColumnRenamed("x", "file").repartition(5)
    got = sorted(map(tuple, token_digests(spark, df, WORDS, 2).collect()))
    assert got == expected(rows)


def test_files_give_random_access(spark, tmp_path):
    rows = [(k, f"word{k % 7} " * (k % 50)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS file", "1 AS shard")
    index = write_tokens(df, f"file://{tmp_path}", WORDS, 2, length=16, rows=4).orderBy("start").collect()
    ids = plain(WORDS, [t for _, t in rows])
    total = 0
    for file in dict.fromkeys(r["file"] for r in index):
        reader = Reader(file, 4)
        mine = [i for r in index if r["file"] == file for i in ids[r["doc_id"]]]
        assert reader.file.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        last = -(-len(mine) // 16) - 1
        for k in (last, 0, last // 2):
            values, mask = reader.sequence(k)
            assert values[mask].tolist() == mine[16 * k : 16 * k + 16] and len(values) == 16
        assert all(reader.file.get_batch(b).num_rows == 4 for b in range(reader.file.num_record_batches - 1))
        total += len(mine)
        reader.close()
    assert total == sum(map(len, ids))


def test_part_of_an_index_can_be_read(spark, tmp_path):
    rows = [(k, "a b c " * k) for k in range(40)]
    index = write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}", WORDS, 2, 8, 2)
    got = sorted(map(tuple, read_tokens(index.where("doc_id % 7 = 3"), 2).collect()))
    assert got == [r for r in expected(rows) if r[0] % 7 == 3]


def test_null_ids_come_first_and_repeated_ids_stay(spark):
    df = spark.createDataFrame([(5, "b"), (None, "a"), (5, "b"), (5, None)], "doc_id long, text string")
    got = token_digests(spark, df, WORDS, 2).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 2), (5, 1), (5, 2), (5, 2)]
    assert min((r["start"], r["doc_id"]) for r in got) == (0, None)
    assert sorted(r["start"] for r in got)[-1] < sum(r["n_tokens"] for r in got) == 7


def test_empty(spark):
    assert token_digests(spark, spark.createDataFrame([], "doc_id long, text string"), WORDS, 2).count() == 0
