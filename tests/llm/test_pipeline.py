import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from hazeframe.llm.queries import QUERIES

from .test_decontamination import expected as leaks
from .test_near_duplicates import expected as groups
from .test_quality_rules import counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    words = [word() for _ in range(400)]
    items = [" ".join(rng.choices(words, k=rng.randint(15, 30))) for _ in range(5)]
    bases = [rng.choices(words, k=rng.randint(12, 120)) for _ in range(60)]
    texts = [" ".join(b) for b in bases]
    texts += [" ".join(w if rng.random() > 0.02 else word() for w in rng.choice(bases)) for _ in range(60)]
    texts += [" ".join(rng.choices(words, k=20)) + " " + rng.choice(items) + " " + word() for _ in range(15)]
    texts += ["too short", "", None, "same words again here " * 20, texts[0], texts[70]]
    rng.shuffle(texts)
    docs = [(k, t, "en", rng.choice(["s1", "s2", "s2", "s3", None]), len(t or "")) for k, t in enumerate(texts)]
    return docs, list(enumerate(items))


def test_every_stage_and_the_whole(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "mixing", "token_output"]
    at, kept = f"{tmp_path}/documents.parquet", {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.read.parquet(at), str(tmp_path))
        out.write.parquet(at := f"{tmp_path}/{name}")
        kept[name] = spark.read.parquet(at)
    for name in names[:-1]:
        assert kept[name].columns == COLUMNS
    rows = {name: {r["doc_id"]: tuple(r) for r in kept[name].collect()} for name in names[:4]}

    # No host fails here, so the base rules decide.
    good = {d[0]: d for d in docs if not counts(d[1])[-1]}
    assert rows["quality_rules"] == good
    single = groups([(k, d[1]) for k, d in good.items()], 5)
    first = {k: good[k] for k, (_, _, keep) in single.items() if keep}
    assert rows["near_duplicates"] == first and len(first) < len(good)
    found = leaks([(k, d[1]) for k, d in first.items()], items)
    clean = {k: d for k, d in first.items() if not found[k][0]}
    assert rows["decontamination"] == clean and len(clean) < len(first)
    assert set(rows["mixing"]) <= set(clean) and all(clean[k] == d for k, d in rows["mixing"].items())

    times = Counter(r["doc_id"] for r in kept["mixing"].collect())
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", d[1])) for k, d in clean.items()}
    per_source, taken, largest = Counter(), Counter(), defaultdict(int)
    for k, d in clean.items():
        per_source[d[3]] += size[k]
        taken[d[3]] += times[k] * size[k]
        largest[d[3]] = max(largest[d[3]], size[k])
    order = sorted(s for s in per_source if s is not None) + [None]
    # No target is over three times its source here, as the second line makes sure.
    total = sum((1, 2, 3, 1, 2)[: len(order)])
    want = {s: sum(per_source.values()) * w / total for s, w in zip(order, (1, 2, 3, 1, 2), strict=False)}
    assert all(want[s] <= 3 * per_source[s] for s in order)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in order)

    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    want = []
    for k in sorted(times.elements()):
        ids = [*tokenizer.encode(clean[k][1], add_special_tokens=False).ids, 2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, kept["token_output"].collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == want


def test_stages_take_nulls_repeated_rows_and_empty_tables(spark, tmp_path):
    rows = [(None, "a clean text of more than ten words that is quite alone in this", None, None, None), (1, None, "en", "s", 0)]
    rows += [(2, "another clean text of more than ten words that is there more than once", "en", "s", 9)] * 3
    spark.createDataFrame([(1, "none of this is in any document at all as far as anyone can tell")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some, want in ((rows, [None, 2]), ([], [])):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES[:3]:
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), schema)
            if name != "quality_rules":
                assert sorted((r["doc_id"] for r in docs.collect()), key=str) == sorted(want, key=str)
        for _, stage in corpus_pipeline.STAGES[3:]:
            assert stage(spark, docs, str(tmp_path)).count() <= 3 * len(want)


def test_texts_that_share_an_id_are_not_lost(spark, tmp_path):
    rng = random.Random(3)
    long = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
    one, two, three = long(), long(), long()
    texts = [(1, one), (1, two), (1, two), (0, three), (1, [*three, "end"]), (2, one), (3, two[:-1]), (4, []), (4, [" "]), (1, [*one, "more"])]
    rows = [(k, " ".join(t), "en", f"s{n}", 0) for n, (k, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = sorted((r["doc_id"], r["text"].split()[:1], r["source"]) for r in stage(spark, docs, str(tmp_path)).collect())
    # Id 1 has two groups of its own, and a near copy of id 0 that goes.
    first = [(r[0], r[1]) for r in got]
    assert first == sorted([(0, three[:1]), (1, one[:1]), (1, two[:1]), (4, []), (4, [])])
    assert [r[2] for r in got if r[1] == two[:1]] == ["s1"]


def test_columns_of_any_name_and_type(spark, tmp_path):
    """Names that the stages use themselves, on columns that cannot be ordered or grouped."""
    names = ["times", "rows", "copy", "row", "one", "each", "leak_key", "text_key", "kept", "kept_id", "good_key", "group_key", "node", "label", "size", "hash", "start", "n_tokens", "a b", "x.y"]
    docs, items = corpus()
    docs = [(*d, *[{n: k % 3} for n in names]) for k, d in enumerate(docs + [(docs[0][0], *docs[0][1:]), (None, *docs[1][1:])])]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` map<string,int>" for n in names)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame(docs, schema).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        assert frame.count() > 10
        assert all(r["a b"] in ({"a b": 0}, {"a b": 1}, {"a b": 2}) for r in frame.select("`a b`").collect())
    assert corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count() == frame.count()


def test_registered_once_each():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
