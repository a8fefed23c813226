"""Small fixtures: nulls, ties, repeated rows, odd texts, empty tables, and the hot paths of each operator."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabkit.llm import bytepairs, chat, langid, lines, nearest, ngramjoin, packing, quality, transducer, urls
from tabkit.llm.components import components
from tests.llm.support import ODD, documents, linked, odd_documents, quality as by_hand, shingles, without_repeats

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark).cache()


# lines

def test_line_dedup_by_brute_force(spark):
    rng = random.Random(3)
    texts = {i: "\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12))) for i in range(60)}
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(rows).collect()}
    expected = without_repeats(texts)
    assert {i: r.text for i, r in got.items()} == expected
    # what goes has an equal line that stays
    left = {x for t in expected.values() for x in t.split("\n")}
    assert all(set(t.split("\n")) <= left | {""} for t in texts.values())


def test_line_dedup_odd(odd):
    got = lines.dedup_lines(odd).orderBy("doc_id").collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (1, 3)}
    assert by_id[8].text == "l1\nl2\nl3\nl4" and by_id[9].text == "" and by_id[10].text == "\n\n\n\n"
    assert lines.dedup_lines(odd.limit(0)).count() == 0
    null = [r for r in got if r.doc_id == 1 and r.text is None]
    assert len(null) == 1 and (null[0].n_lines, null[0].n_removed) == (0, 0)


def test_line_dedup_is_native(spark, odd):
    for df in (lines.dedup_lines(odd), quality.judge_quality(odd), chat.format_chats(chats(spark, [(1, 0, "user", "x")]))):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


# tokens

def test_transducer_on_odd_and_random_texts():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rng = random.Random(5)
    letters = "abcdehilnorst' !?.,0129éßΣİ中\U0001F600#*\n\x1c\x85"
    texts = [t for t in ODD if t] + ["<|endoftext|>x<|ENDOFTEXT|>", "th" * 2000, "'re''ve'D", "a\u0301b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(200)]
    assert transducer.count_batch(texts, WORDS) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_transducer_composes_over_any_cut(monkeypatch):
    texts = ["the quick brown fox", "x" * 500, "", "a b c"]
    whole = transducer.count_batch(texts, WORDS)
    for size in (1, 2, 7):
        monkeypatch.setattr(transducer, "CHUNK", size)
        assert transducer.count_batch(texts, WORDS) == whole


def test_transducer_starts_anew_when_full(monkeypatch):
    machine = transducer.Transducer(WORDS)
    monkeypatch.setitem(transducer._MACHINES, WORDS, machine)
    monkeypatch.setattr(transducer, "TABLE_CELLS", 1)
    assert transducer.count_batch(["hello world"] * 3, WORDS) == [2] * 3


def test_token_counts_odd(odd):
    got = transducer.count_tokens(odd, WORDS, 10).toPandas()
    assert len(got) == odd.count() and (got[got.doc_id == 1].n_tokens == 0).all()
    assert transducer.count_tokens(odd.limit(0), WORDS, 10).count() == 0


def test_byte_pairs_long_pieces_and_round_trip():
    import tiktoken

    coder = bytepairs.coder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(7)
    texts = [t or "" for t in ODD] + ["ab" * 3000, " \n  x\t\ty \r\n"] + [
        "".join(rng.choice("abth e'0é中\n ") for _ in range(rng.randrange(400))) for _ in range(200)]
    got = [b"".join(p) for p in coder.encode(texts)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(g) for g in got] == [t.encode() for t in texts]


def test_byte_pairs_cache_overflow_and_segments(monkeypatch):
    coder = bytepairs.BytePairs(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(bytepairs, "CACHE_PIECES", 3)
    monkeypatch.setattr(bytepairs, "BATCH_CHARS", 10)
    texts = ["some words that are many", "", "some other words", "x"]
    assert [coder.decode(b"".join(p)) for p in coder.encode(texts)] == [t.encode() for t in texts]


def test_byte_pairs_tables(odd):
    encoded = bytepairs.encode_documents(odd, RANKS, public_tokenizers.PATTERN)
    back = bytepairs.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).toPandas()
    texts = sorted((r.text or "").encode() for r in odd.select("text").collect())
    assert sorted(bytes(x) for x in back.text) == texts
    assert bytepairs.coding_digest(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# languages

def test_languages_odd(spark, odd):
    got = langid.identify_languages(odd).toPandas()
    assert len(got) == odd.count() and got.score.between(0, 1).all()
    assert set(got[got.doc_id.isin([2, 10])].lang_pred) == {"und"}
    nothing = langid.identify_languages(odd.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert set(nothing.lang_pred) == {"und"} and (nothing.score == 0).all()
    assert langid.identify_languages(odd.limit(0)).count() == 0


def test_languages_learn_from_text_only(spark):
    texts = ["the house and the garden are there"] * 30 + ["la maison et le jardin sont ici"] * 30
    langs = ["en"] * 30 + ["fr"] * 30
    docs = documents(spark, texts, langs)
    a = langid.identify_languages(docs).filter("held_out").orderBy("doc_id").collect()
    b = langid.identify_languages(docs.withColumn("lang", F.when(langid.held_out("doc_id"), "xx").otherwise(F.col("lang")))).filter("held_out").orderBy("doc_id").collect()
    assert [r.lang_pred for r in a] == [langs[r.doc_id - 1] for r in a]
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_grams_do_not_depend_on_cuts(monkeypatch):
    text = "Un été à la maison, " * 50
    whole = next(langid.count_blocks([text])).copy()
    from tabkit.llm import wordsplit
    monkeypatch.setattr(wordsplit.segments, "__defaults__", (64,))
    assert (next(langid.count_blocks([text])) == whole).all()


# urls

def test_urls_odd_and_false_positives(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://A.Example.NET/en/x?q#f"), (5, "http://example.net/en"), (6, "http://x.net"),
         (7, "http://xnet/"), (8, "a://b://net/"), (9, "http://u.example.com/de/1"), (9, "http://u.example.com/de/1"), (None, "http://q.org/fr/")],
        "page_id bigint, url string").withColumn("verdict", F.lit("old"))
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/x", "block"), ("u.example.com", None, "allow")],
        "host string, path string, verdict string")
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()), key=str)
    assert got == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (5, "example.net", "/en", "net/", "block"), (6, "x.net", "", None, "allow"), (7, "xnet", "/", None, "allow"), (8, "b:", "//net/", None, "allow"),
        (9, "u.example.com", "/de/1", "example.com/de/", "block"), (9, "u.example.com", "/de/1", "example.com/de/", "block"), (0, "q.org", "/fr/", "org/fr/", "allow"),
    ], key=str)
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_bloom_loses_nothing_and_passes_little(spark):
    listed = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    bloom, blocks = urls.blocked_bloom(listed, "k", 5000)
    asked = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"))
    hits = urls.possible_hits(asked, "k", bloom, blocks).count()
    assert 5000 <= hits < 5000 + 0.01 * 15000


# joins

def near_copies(rng, n_groups=6, copies=14, size=120):
    texts = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, size))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = f"v{rng.randrange(1000)}"
            texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("size,percent,rare,hot,rounds", [(4, 85, None, 4096, 32), (5, 80, 0, 3, 4)])
def test_join_by_brute_force(spark, size, percent, rare, hot, rounds):
    rng = random.Random(size)
    texts = near_copies(rng) + ["a b c", "A B\tC", "", "x", "a b c d e f g h i j k", "a b c d e f g h i j"] * 2
    docs = documents(spark, texts)
    links = ngramjoin.link_documents(docs, size, percent, rare=rare, hot=hot, rounds=rounds)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in links.collect()}
    expected = linked(dict(enumerate(texts, 1)), size, percent)
    assert got == {i: (len(shingles(texts[i - 1], size)), c) for i, c in expected.items()}


def test_join_odd_and_one_of_each(spark, odd):
    links = ngramjoin.link_documents(odd)
    assert links.count() == odd.count()
    stay = ngramjoin.one_of_each(odd, links)
    assert stay.columns == odd.columns
    texts = [r.text for r in stay.collect()]
    assert texts.count("l1\nl2\nl3\nl4") == 1 and None in texts and "" in texts
    assert ngramjoin.link_documents(odd.limit(0)).count() == 0


def test_one_of_each_of_components_with_one_id(spark):
    """Unlike documents stay where their ids are null or the same; of those that link one stays."""
    texts = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"}
    rows = [(None, "a"), (None, "b"), (None, "b"), (None, "c"), (7, "d"), (7, "e"), (7, "e"), (8, "e"), (9, "f"), (None, "f")]
    docs = spark.createDataFrame([(i, texts[k] + (" tail" if (i, k) == (8, "e") else "")) for i, k in rows], "doc_id bigint, text string")
    stay = ngramjoin.one_of_each(docs, ngramjoin.link_documents(docs)).collect()
    assert sorted(((r.doc_id, r.text) for r in stay), key=str) == sorted(
        [(None, texts["a"]), (None, texts["b"]), (None, texts["c"]), (7, texts["d"]), (7, texts["e"]), (9, texts["f"])], key=str)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


# quality

def test_measures_by_hand(spark, odd):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) + "\n#x\n#x \n" for _ in range(40)]
    for docs in (documents(spark, texts), odd):
        for r in quality.text_measures(docs).collect():
            expected = by_hand(r.text)
            assert {k: r[k] for k in expected} == expected


def test_quality_odd(odd, spark):
    got = quality.judge_quality(odd).collect()
    assert len(got) == odd.count() and not any(r.kept for r in got if not r.text)
    assert quality.judge_quality(odd.limit(0)).count() == 0


def test_quality_thresholds_follow_the_group(spark):
    rng = random.Random(1)
    clean = [" ".join("abcdefgh"[: rng.randrange(3, 8)] + str(rng.random()) for _ in range(40)) for _ in range(50)]
    junk = [c.replace(" ", " ### $$$ ") for c in clean[:3]]
    got = quality.judge_quality(documents(spark, clean + junk)).orderBy("doc_id").collect()
    assert all(r.kept for r in got[:50]) and not any(r.kept for r in got[50:])


def test_bins_keep_leading_bits(spark):
    got = spark.range(0, 5000).select("id", quality.bin_floor(F.col("id")).alias("b")).collect()
    assert all(r.b <= r.id and (r.id - r.b) * 32 <= max(r.id, 1) and (r.id >= 64 or r.b == r.id) for r in got)


# nearest

def brute_top(rows, k, every):
    out = []
    for i, (q, v) in enumerate(rows):
        if q is not None and q % every == 0:
            scored = sorted((-int(np.dot(v, w)), c) for j, (c, w) in enumerate(rows) if j != i)
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6)).astype("float32")
    x[100:300] = x[100]  # a very common vector
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)] + [(50, [1.0] * 6), (7, [0.5, 0.25])]
    odd = [(500, None), (550, [1.0, None, 2.0]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1))
    whole = [(i, np.floor(256 * np.array(v + [0.0] * (6 - len(v)), "float32").astype(float)).astype(int)) for i, v in rows]
    got = nearest.top_k(table, 5, 50, cell_rows=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute_top(whole, 5, 50)


def test_top_k_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nearest.top_k(table, 5, 50).collect()] == [(0, 1, 1, 256 * 512)]
    assert nearest.top_k(table.limit(0), 5, 50).count() == 0


def test_annuli_are_skipped():
    """Two far clusters: a query's bound does not reach the other one's cells."""
    v = np.concatenate([np.eye(4, dtype=np.int64)[:1].repeat(8, 0) * 256, np.eye(4, dtype=np.int64)[1:2].repeat(8, 0) * 256])
    index = nearest.Index(np.zeros((0, 1)), 256.0**2, 4, True)
    index.pivots = index.lifted(v[[0, 8]])
    index.cells = np.array([[0, 0, 0.0, 1.0, 8], [1, 0, 0.0, 1.0, 8]])
    reach = index.radius(v[:1], np.array([256.0**2])) + index.slack()
    assert (index.bounds(v[:1]) <= reach[:, None]).tolist() == [[True, False]]


# packing

def least_bins(counts, capacity):
    """No packing needs fewer: items above half are apart, and those of k to half fill what the middle ones leave."""
    best = 0
    for k in range(capacity // 2 + 1):
        big = sum(c for n, c in counts.items() if n > capacity - k)
        middle = {n: c for n, c in counts.items() if capacity / 2 < n <= capacity - k}
        room = sum((capacity - n) * c for n, c in middle.items())
        small = sum(n * c for n, c in counts.items() if k <= n <= capacity / 2)
        best = max(best, big + sum(middle.values()) + max(0, -(-(small - room) // capacity)))
    return best


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_exact_and_tight(seed):
    rng = random.Random(seed)
    capacity = 64
    counts = {n: rng.randrange(1, 40) for n in rng.sample(range(1, capacity + 1), 30)}
    plan = packing.Plan(counts, capacity)
    spans, ranks = {}, {n: set() for n in counts}
    rows = sorted(plan.rows)
    for i, (n, rank, first, each, offset) in enumerate(rows):
        until = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == n else counts[n]
        for r in range(rank, until):
            k = r - rank
            ranks[n].add(r)
            spans.setdefault(first + k // each, []).append((offset + k % each * n, n))
    assert all(ranks[n] == set(range(c)) for n, c in counts.items())
    for parts in spans.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= capacity
    assert len(spans) == plan.sequences <= 1.06 * least_bins(counts, capacity) + 1


def test_word_ids_as_the_library_on_whole_texts():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rng = random.Random(11)
    letters = "abcdehilnorstJTHS' !?.,0129\u00e9\u00df\u03a3\u0130\u030c\u0308\u0331\u0301\u4e2d\U0001F600#*<|>\n\x1c\x85\u00a0\u3000"
    texts = [t for t in ODD if t] + ["<|ENDOFTEXT|>", "a<|EndOfText|>b <|endoftext|> <|STARTOFTEXT|>", "J\u030c T\u0308 H\u0331", "j\u030c E\u0301 \u03a3\u03a3 'S"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(300)]
    encode = packing.WordIds(WORDS).encode
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_odd(odd):
    got = packing.pack_documents(odd, WORDS, 16, 1).toPandas().sort_values(["sequence_id", "offset"])
    sizes = got.groupby("sequence_id")["length"]
    assert (sizes.cumsum() - got["length"] == got["offset"]).all() and sizes.sum().max() <= 16
    assert got.groupby("piece").size()[0] == odd.count()
    assert packing.pack_documents(odd.limit(0), WORDS).count() == 0


# chats

def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("x"))


def test_chats_read_back(spark):
    hard = "<|im_start|>user\n%3C <|im_sep|><|im_end|>\n <<|im_end|> </s>[INST] 50% %25 [/INST]"
    rows = [(1, 2, "assistant", hard), (1, 0, "system", None), (1, 1, "user", "q\n"), (1, 3, "assistant", "more"), (2, 0, None, ""), (2, 1, "ro\nle%0A", "x"),
            (None, 0, "user", "n"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, None, "user", "first")]
    table = chat.format_chats(chats(spark, rows))
    got = {r.conv_id: r for r in table.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    turns = {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()}
    assert turns == {
        1: [("system", ""), ("user", "q\n"), ("assistant", hard), ("assistant", "more")], 2: [("", ""), ("ro\nle%0A", "x")],
        None: [("user", "n")], 3: [("user", "first"), ("user", "tie"), ("user", "tie")],
    }
    assert got[1].loss == hard + "more" and got[2].loss == ""
    assert got[1].formatted.count("<|im_start|>") == 3  # the two assistant turns are one block
    assert chat.format_chats(chats(spark, rows).limit(0)).count() == 0


def test_controls_must_be_plain():
    with pytest.raises(ValueError):
        chat._firsts(["<a<"])


# pipeline

def test_pipeline_by_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    state = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(state)
            break
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        got = {r.doc_id: r.text for r in out.collect()}
        if name == "line dedup":
            assert got == without_repeats(state)
        elif name == "near duplicates":
            assert set(got) == set(linked(state, 5, 80).values())
        else:
            assert got.items() <= state.items()
            assert len(got) > 0.7 * len(state)
        state, docs = got, spark.createDataFrame(out.collect(), out.schema)


def test_stages_keep_own_columns(spark, odd):
    """Quality and lines on odd rows, whose columns are named like results: each row that stays is as it was, the text of cut ones aside."""
    long = documents(spark, ["a b c d e f g h i j k l m n o p q r s t u v w"] * 2)
    table = long
    for name in ("n_words", "kept", "n_lines", "n_removed", "own_n_lines", "_pred"):
        table = table.withColumn(name, table.doc_id * 7)
    good = corpus_pipeline.check_quality(spark, table, "")
    assert good.columns == table.columns and sorted(good.collect()) == sorted(table.collect())
    cut = corpus_pipeline.drop_repeated_lines(spark, odd.drop("n_chars"), "")
    assert cut.columns == odd.drop("n_chars").columns and cut.count() == odd.count()
    assert cut.filter("doc_id is not null and n_lines <> doc_id").count() == 0
