"""The operators of daybook.llm on small tables, against brute force or SQL."""

import collections
import hashlib
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import (byte_bpe, chat_pairs, common, host_quality, language_id, license_scan, line_chunks, near_dup,
                         sketch_diff, source_mix, token_files)
from daybook.llm.queries import ORACLE, QUERIES
from daybook.session import scratch_path
from duck_compare import compare_one, duck

P = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone string, kind int, word string, _at int"


def words(n, seed=1):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 8))) for _ in range(n))


LONG = words(3000)
TEXTS = [None, "", " \t\n", "Released under the MIT License.", "x", "é" * 300, LONG, LONG, LONG + " tail",
         "one two three four five six seven eight nine ten\nline b\nline c\nline d\nline e",
         "intro\none two three four five six seven eight nine ten\nline b\nline c\nline d\nline e",
         "Prose.\n\nCopyright (c) 2020 X\nLicenced under the Apache Licence, Version 2.0!", "a" * 5000, "日本語 текст ½ 'll 12"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s" if i % 3 else None, 0, "g", 1, "w", 2) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[6:7] + [(None, "null id text", "de", "s", 0, "g", 1, "w", 2)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = compare_one(spark, duck(SMALL), SMALL, name, QUERIES[name], ORACLE[name])
    assert got["ok"], got


def test_license_scan(docs, empty):
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    assert got[3]["whole_license"] == "MIT" and got[3]["licenses"] == ["MIT"]
    assert got[11]["whole_license"] is None and got[11]["licenses"] == ["Apache-2.0"]
    assert got[0]["licenses"] == [] and got[None]["licenses"] == [] and len(got) == len(TEXTS) + 1
    assert license_scan.scan_licenses(empty).count() == 0


def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    tokenizer = Tokenizer.from_str(text)
    odd = ["H\u0331ello W\u030Aorld T\u0308", "a <|endoftext|> b", "<|startoftext|>x", "A <|ENDOFTEXT|> B", "Abc aBC\u00a0x\u3000\u0130"]
    more = docs.unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"), True)
    manifest = token_files.write_tokens(more, text, scratch_path(spark, "t"))
    got = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 0, 1, 2, 3, 4, 5, 6, 6, *range(7, len(TEXTS)), *range(100, 100 + len(odd))]
    at = 0
    for r in got:
        source = "null id text" if r["doc_id"] is None else odd[r["doc_id"] - 100] if r["doc_id"] >= 100 else TEXTS[r["doc_id"]] or ""
        assert r["token_ids"] == tokenizer.encode(source, add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"]) == (at, len(r["token_ids"]))
        at += r["n_tokens"]
    shard = token_files.open_shard(manifest.first()["path"])
    assert shard.schema.field("ids").type.list_size == token_files.SEQUENCE
    assert token_files.read_documents(token_files.write_tokens(empty, text, scratch_path(spark, "t"))).count() == 0


def test_source_mix(spark, docs, empty):
    got = collections.Counter(r["doc_id"] for r in source_mix.mix_sources(docs, weights={"s": 1.0}, epochs=40.0).collect())
    assert all(TEXTS and i % 3 for i in got if i is not None) and sum(got.values()) > 300
    assert source_mix.mix_sources(empty).count() == 0
    even = spark.range(4000).selectExpr("id AS doc_id", "if(id < 3000, 'a', 'b') AS source")
    by = {r["source"]: r["count"] for r in source_mix.mix_sources(even, weights={"a": 1.0, "b": 3.0}).groupBy("source").count().collect()}
    assert abs(by["a"] - 1000) < 150 and abs(by["b"] - 3000) < 250


def test_names_that_clash(spark):
    """Columns of the names that operators use or add pass through."""
    table = spark.createDataFrame([(1, "one two three", "en", "s", 5, 6, "p", [1.5], "x", "lp", 0.5)],
                                  "doc_id long, text string, lang string, source string, poisson int, copy int, part string, "
                                  "`token_ids` array<double>, `a.b` string, lang_pred string, score double").selectExpr("*", "named_struct('x y', 1) AS `st ruct`")
    given = table.first()
    mixed = source_mix.mix_sources(table, weights={"s": 1.0}, epochs=30.0, copy_col="copy")
    assert mixed.columns == [*table.columns, "_copy"] and tuple(mixed.first())[:-1] == tuple(given)
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    out = byte_bpe.decode(byte_bpe.encode(table, ranks, P.PATTERN), ranks)
    assert out.columns == [*table.columns, "_token_ids", "decoded"] and tuple(out.first())[:-2] == tuple(given)
    assert out.first()["decoded"] == b"one two three"
    model = language_id.train_on_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))
    found = language_id.predict(table, model)
    assert found.columns == [*table.columns, "_lang_pred", "_score"] and tuple(found.first())[:-2] == tuple(given)


def test_language_id(spark, docs, empty):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train_on_documents(table)
    found = language_id.predict(table, model).where(language_id.held_out()).selectExpr("avg(int(lang = lang_pred)) a").first()
    assert found["a"] >= 0.95
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[0]["score"] == 0
    assert got[6]["lang_pred"] != "und" and 0 < got[6]["score"] <= 1
    none = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_language_id_holds_few_counts():
    """A batch of training texts is counted text by text."""
    texts = [words(8, k) for k in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 2000), pa.array(texts)], ["label", "text"])
    tracemalloc.start()
    out = list(language_id._counted([batch]))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # 2000 arrays of DIM counts are 131 MB
    for k in (0, 1999):
        want = language_id.features(texts[k])
        at, n = (np.frombuffer(out.column(j)[k].as_py(), t) for j, t in ((1, np.uint16), (2, np.float32)))
        assert at.tolist() == np.flatnonzero(want).tolist() and n.tolist() == want[at].tolist()


def test_sketch_diff(docs, empty):
    got = sketch_diff.compare_with_next(docs).collect()
    rows = sorted([(-1, "null id text")] + [(i, t or "") for i, t in [*enumerate(TEXTS), (6, LONG)]])
    want = collections.Counter()

    def cut(text):
        """Paragraphs by the definition, character by character."""
        out = []
        for line in text.split("\n"):
            out.append("")
            for k, c in enumerate(line):
                out[-1] += c
                at = sum(len(x) + 1 for x in text.split("\n")[:len(starts)]) + k
                a, b, d = (ord(text[j]) if j >= 0 else 0 for j in (at, at - 1, at - 2))
                h = (a * 0x9E3779B1 + b * 0x85EBCA77 + d * 0xC2B2AE3D) % 2 ** 32
                h = (h ^ h >> 15) * 0x2C1B3C6D % 2 ** 32
                if h >> 27 == 0 or k == 7:
                    out.append("")
            starts.append(0)
        starts.clear()
        return [x for x in out if x]

    starts = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]

        def like(x, y):
            a, b = (collections.Counter(cut(s)) for s in (x, y))
            return round(sum((a & b).values()) / (sum((a | b).values()) or 1), 9) if a or b else 1.0
        want[(None if i < 0 else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), like(t, edited), like(t, after))] += 1
    assert want == collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
                                        round(r["near_next"], 9)) for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (6, 7)}) == 1
    assert sketch_diff.compare_with_next(empty).count() == 0


def test_byte_bpe_is_tiktoken(docs, empty):
    import tiktoken

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.decode(byte_bpe.encode(docs, ranks, P.PATTERN), ranks, decimal_col="decimals").collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        assert r["token_ids"] == own.encode_ordinary(r["text"] or "") and r["decoded"].decode() == (r["text"] or "")
        assert r["decimals"] == ",".join(map(str, r["token_ids"])) and (r["gone"], r["word"]) == ("g", "w")
    assert byte_bpe.encode(empty, ranks, P.PATTERN).count() == 0


def test_byte_bpe_deals_and_stores_nothing(spark, docs, monkeypatch):
    """Words beyond the common ones of a sample are folded in the pass, part by part."""
    import tiktoken

    for name, value in (("COMMON", 5), ("SAMPLE", 3000), ("PART_WORDS", 200), ("BLOCK", 2)):
        monkeypatch.setattr(byte_bpe, name, value)
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with common.scratch() as tables:
        encoded = byte_bpe.encode(docs.coalesce(1), ranks, P.PATTERN)
        rows = encoded.collect()
    assert tables == [] and "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == len(TEXTS) + 2 and all(r["token_ids"] == own.encode_ordinary(r["text"] or "") for r in rows)


def test_byte_bpe_folds_in_one_arrow_pass(docs):
    """No map of ranks in the plan, and no words sent to the JVM and back."""
    import tiktoken

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plan = byte_bpe.encode(docs, ranks, P.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "from_json" not in plan and "entries" not in plan
    draw = random.Random(5)
    words = ["".join(draw.choices(letters, k=draw.randint(1, most))).encode() for letters, most in
             [("ab", 60), ("aeinrst", 200), (" a", 40), ("é日本語中x", 50), ("\x00\n\t", 9)] for _ in range(200)]
    words += [b"a" * k for k in range(1, 90)] + ["".join(draw.choices("abcdefghij", k=20_000)).encode()]
    sizes, values = byte_bpe.Merges(ranks).fold(words)
    lists = [v.tolist() for v in np.split(values, np.cumsum(sizes)[:-1])]
    assert lists == [own._encode_single_piece(w) for w in words]
    # Ranks of part of the bytes: pieces are merged over the others, which have no id alone.
    merges = byte_bpe.Merges({b"a": 0, b"xy": 1, b"axy": 2})
    sizes, values = merges.fold([b"axya", b"", b"xxy", b"a"])
    assert sizes.tolist() == [2, 0, 2, 1] and [v if v < merges.end else None for v in values.tolist()] == [2, 0, None, 1, 0]


def test_chat_pairs(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "yo"), (1, 2, "user", "bye"), (2, 0, "user", "q"),
            (3, 0, None, None), (3, 1, "assistant", "yo"), (3, 1, "assistant", "yo"), (None, 0, "assistant", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_pairs.format_pairs(chat_pairs.pairs_by_next_reply(turns)).collect()}
    assert set(got) == {1, 3}
    assert got[1]["prompt"].startswith("<|im_start|>user\nhi < |im_end|><|im_end|>\n") and got[1]["chosen"] == ""
    pair = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "c"), ("user", "d")])],
                                 "conv_id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    r = chat_pairs.format_pairs(pair).first()
    whole = r["prompt"] + r["rejected"]
    assert r["n_common"] == 1 and [whole[a:b] for a, b in r["rejected_mask"]] == ["c<|im_end|>\n"]
    assert chat_pairs.format_pairs(chat_pairs.pairs_by_next_reply(turns.limit(0))).count() == 0


def test_line_chunks(docs, empty):
    got = collections.defaultdict(list)
    for r in line_chunks.dedup_line_chunks(docs).collect():
        assert (r["gone"], r["_at"]) == ("g", 2)
        got[r["doc_id"]].append(r["text"])
    assert got[0] == [None] and got[1] == [""] and got[6] == [LONG, LONG] and got[None] == ["null id text"]
    assert got[9] == [TEXTS[9]] and len(got[10][0]) < len(TEXTS[10])
    assert line_chunks.dedup_line_chunks(empty).count() == 0


def test_near_dup(spark, docs, empty):
    r = random.Random(5)
    base = words(60, 9).split()
    texts = [" ".join(w if r.random() > p else "zz%d" % r.randint(0, 9) for w in base) for p in (0, .01, .02, .04) for _ in range(12)]
    made = list(enumerate(texts + [t or "" for t in TEXTS]))
    table = spark.createDataFrame(made, "doc_id long, text string")
    sets = {i: set(near_dup.shingles(near_dup.words_of(t))) for i, t in made}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dup.near_duplicates(table).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS) + 2 and [r["kept"] for r in rows if r["doc_id"] in (7, 8)] == [False, False]
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert near_dup.drop_near_duplicates(docs).columns == docs.columns
    assert near_dup.near_duplicates(empty).count() == 0


def test_host_quality(docs, empty):
    got = {r["doc_id"]: r for r in host_quality.judge_by_host(docs).collect()}
    assert got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    assert got[6]["n_words"] == 3000 and got[5]["word_chars"] == 300 and got[11]["n_symbols"] == 0
    assert host_quality.judge_by_host(empty).count() == 0


def test_host_prior_shrinks_small_hosts_and_rejects_bad_ones(spark):
    good, bad = words(40, 3), "x"
    # Hosts of one document each: their rates of 0 and 1 are chance, all stay near the mean.
    small = spark.createDataFrame([(i, bad if i % 4 == 0 else good, f"h{i}") for i in range(120)], "doc_id long, text string, source string")
    rates = [r["host_rate"] for r in host_quality.judge_by_host(small).collect()]
    assert max(rates) - min(rates) < 0.01 and abs(rates[0] - 0.25) < 0.01
    # A large host most of which fails is rejected, its good documents too; a small one with a failure is not.
    rows = [(i, bad if i % 10 else good, "bad") for i in range(400)] + [(1000 + i, good, f"g{i % 8}") for i in range(800)]
    rows += [(5000, bad, "tiny"), (5001, good, "tiny2"), (5002, good, "tiny")]
    got = {r["doc_id"]: r for r in host_quality.judge_by_host(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not got[0]["base_failed"] and not got[0]["kept"] and got[0]["host_rate"] > 0.8
    assert all(got[1000 + i]["kept"] for i in range(800)) and got[5002]["kept"] and got[5001]["kept"] and not got[5000]["kept"]


def test_pipeline(spark):
    import corpus_pipeline as C

    docs = C.table(spark, SMALL, "documents")
    before = docs.count()
    for name, stage in C.STAGES[:3]:
        after = C.stored(stage(spark, docs, SMALL), "test-stage")
        assert after.columns == docs.columns and 0.9 * before <= after.count() <= before
        docs = after
    rates = {r["mix_source"]: r["rate"] for r in source_mix.target_rates(docs).collect()}
    want = collections.Counter()
    for r in docs.collect():
        u = int(hashlib.md5(f"17:{r['doc_id']}:1".encode()).hexdigest()[:13], 16) / 2 ** 52
        p = total = np.exp(-rates[r["source"]])
        n = 0
        while total <= u:
            n += 1
            p *= rates[r["source"]] / n
            total += p
        want[(r["doc_id"], r["text"])] += n
    docs = C.stored(C.STAGES[3][1](spark, docs, SMALL), "test-stage")
    mixed = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert mixed == +want
    last = C.STAGES[4][1](spark, docs, SMALL).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in last) == mixed


def test_pipeline_drops_doubtful_languages(spark):
    import corpus_pipeline as C

    docs = C.table(spark, SMALL, "documents")
    by, r = collections.defaultdict(list), random.Random(3)
    for row in docs.orderBy("doc_id").collect():
        by[row["lang"]].append(row["text"])
    bad = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(500)) for _ in range(10)]
    bad += ["\n".join(texts[k][:300] for texts in by.values()) for k in range(3)]
    # No label, so that they are not trained on.
    planted = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(bad)], "doc_id long, text string")
    every = docs.unionByName(planted, allowMissingColumns=True)
    kept = {row["doc_id"] for row in C.identify_language(spark, every, SMALL).collect()}
    assert kept == {row["doc_id"] for row in docs.collect()}
    # A family of one language: the lowest score is a half, and the limit follows.
    two = every.where("lang IS NULL OR lang IN ('en', 'fr')")
    assert language_id.train_on_documents(two).lowest_scores() == {"en": 0.5, "fr": 0.5}
    kept = {row["doc_id"] for row in C.identify_language(spark, two, SMALL).collect()}
    assert kept >= {row["doc_id"] for row in two.where("lang IS NOT NULL").collect()} and len(kept & set(range(-10, 0))) < 5
    assert C.identify_language(spark, every.where("lang IS NULL"), SMALL).count() == 0


def test_near_dup_keeps_pairs_at_the_threshold():
    lost, alive = 0.0, {0: 1.0}
    for _, least in near_dup.least_matches():
        after = collections.Counter()
        for m, p in alive.items():
            for k in range(near_dup.BATCH + 1):
                after[m + k] += p * math.comb(near_dup.BATCH, k) * 0.8 ** k * 0.2 ** (near_dup.BATCH - k)
        lost += sum(p for m, p in after.items() if m < least)
        alive = {m: p for m, p in after.items() if m >= least}
    assert lost < 1e-5


def test_near_dup_one_id_of_several_texts(spark):
    one, two, three = (words(80, k) for k in (31, 32, 33))
    rows = [(1, one), (1, two), (1, three), (1, one), (2, one + " tail"), (3, two + " tail"), (4, three + " tail"),
            (5, two), (6, words(80, 34)), (7, one), (7, words(80, 35)), (8, words(80, 35) + " tail")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(table).collect())
    assert got == collections.Counter((i, 6 if i == 6 else 1, i in (1, 6)) for i, _ in rows)


def test_line_runs_go_whole(spark, docs, empty):
    import corpus_pipeline as C

    r = random.Random(8)
    own = [[words(9, 1000 * d + k) for k in range(6)] for d in range(30)]
    passages = [[words(-(-55 // n), 50 * n + k) for k in range(n)] for n in (2, 3, 4, 7) for _ in (0, 1)]
    passages = [[f"{line} p{j}" for line in p] for j, p in enumerate(passages)]
    made, want = [], []
    for d, lines in enumerate(own):
        picks = r.sample(range(len(passages)), 3) if d else range(len(passages))
        at, full, left = sorted(r.sample(range(7), 3)), [], []
        for k in range(7):
            for p in ([passages[j] for j in picks] if k == 3 else []) if not d else [passages[j] for j, x in zip(picks, at) if x == k]:
                full += p[:1] + [""] + p[1:] if len(p) == 7 else p
                left += (p[:1] + [""] + p[1:] if len(p) == 7 else p) if not d else []
            full += lines[k:k + 1]
            left += lines[k:k + 1]
        made.append((d, "\n".join(full), "k"))
        want.append((d, "\n".join(left), "k"))
    table = spark.createDataFrame(made, "doc_id long, text string, gone string")
    assert sorted(tuple(x) for x in C.drop_repeated_lines(spark, table, SMALL).collect()) == want
    got = collections.defaultdict(list)
    for row in line_chunks.dedup_line_runs(docs).collect():
        assert (row["gone"], row["_at"]) == ("g", 2)
        got[row["doc_id"]].append(row["text"])
    assert got[0] == [None] and got[1] == [""] and got[6] == [LONG, LONG] and got[None] == ["null id text"]
    assert got[9] == [TEXTS[9]] and got[10] == ["intro"]
    assert line_chunks.dedup_line_runs(empty).count() == 0
    # Within a text, and rows that share an id: one document, positions of their own.
    rows = [(1, "a\nb\nc\na\nb"), (1, "z\na\nb"), (2, "q\na\nb"), (2, "a\nb\nr"), (3, "x\nx\nx")]
    got = line_chunks.dedup_line_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, "a\nb\nc"), (1, "z\na\nb"), (2, "q"), (2, "r"), (3, "x\nx\nx")]
