"""The operators against brute force, and their defined results for nulls, empties, ties, repeats and clashing names."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, html_text, jaccard_join, language_id, lm_scores, quality_rules, queries, sentencepiece_codec, token_counts, url_filter, warc_store
from rollcall.llm.common import table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two three"), (6, "a b c d e f g h i j k l"), (7, "a b c d e f g h i j k l"),
    (8, LONG), (9, LONG + " end"), (10, "¿é ü? ☃ \U0001f600 x\x00y"), (11, "123 456 !!"), (12, "the of and\n\nthe of and\nthe of and"), (None, "no id at all here"),
]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, None, None) for i, t in rows], DOC)


def clashing(df):
    """The same with columns that operators use by name inside."""
    out = df
    for c in ("id", "n", "first", "sig", "root", "_words", "_text", "score", "lang_pred", "host", "digest", "url2"):
        out = out.selectExpr("*", f"1 AS `{c}`") if c not in out.columns else out
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_sentencepiece_equals_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    both = docs.select("doc_id", "text").union(odd(spark).select("doc_id", "text").where("doc_id is not null"))
    got = {r.doc_id: r for r in sentencepiece_codec.encode(both.selectExpr("doc_id + 0 AS doc_id", "text"), "doc_id", "text", queries.PIECES).collect()}
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    for i, t in texts.items():
        if list(texts).count(i) == 1 and i > 12:
            ids = sp.encode(t)
            assert got[i].ids == ids and got[i].decoded == sp.decode(ids)
    for _, t in ODD:
        b = (t or "").encode()
        ids, starts, ends = sentencepiece_codec.codec(queries.PIECES).encode(b)
        assert ids == sp.encode(t or "")
        surfaces = sp.encode(t or "", return_type="proto").pieces
        assert all(p.surface == "" or b[s:e].decode(errors="replace") == p.surface for p, s, e in zip(surfaces, starts, ends, strict=True))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_map_and_alignment(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    m = pb.ModelProto()
    m.ParseFromString(library.serialized_model_proto())
    own = sentencepiece_codec.Normaliser(m.normalizer_spec)
    for t in ("", "  Ａｂｃ  ﬁ ① x　y ", "​é ㍿ ½  ", "   ", "tab\tline\nz"):
        text, offsets = library.normalize(t, with_offsets=True)
        out, align = own(t.encode())
        assert out.decode() == text
        if text:
            places = [len(t.encode()[: align[len(text[:k].encode())]].decode()) for k in range(len(text) + 1)]
            assert places == list(offsets)[: len(places)]


def test_digests(spark):
    df = odd(spark)
    for r in sentencepiece_codec.encode_digests(clashing(df), "doc_id", "text", queries.PIECES).collect():
        assert len(r.ids_sha256) == 64
        if r.doc_id in (1, 2):
            assert r.n_tokens == 0 and r.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_url_parts_and_rules(spark):
    urls = [
        ("http://A.Example.NET/en/x?q=1#f", "a.example.net", "/en/x", "example.net/en/"), ("https://foo.net?x", "foo.net", "", None), ("ftp://foo.net/", "foo.net", "/", "net/"),
        ("x://b.org/fr/", "b.org", "/fr/", "org/fr/"), ("http://myexample.com/de/", "myexample.com", "/de/", None), ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/"),
        ("no scheme", "", "", None), (None, "", "", None), ("http://ÄB.net/\n", "Äb.net", "/\n", "net/"), ("", "", "", None),
    ]
    df = clashing(spark.createDataFrame([(k, u[0]) for k, u in enumerate(urls)], "page_id long, url string"))
    got = {r.page_id: r for r in url_filter.report(df).collect()}
    for k, (_, host, path, rule) in enumerate(urls):
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == {None: got[k].verdict, "net/": "block", "example.net/en/": "allow", "org/fr/": "allow", "example.com/de/": "block"}[rule]


def test_url_trees_hold_out(spark):
    labelled = url_filter.seed_urls(2000, 3)
    m = url_filter.fit([u for u, _ in labelled[:1000]], [b for _, b in labelled[:1000]])
    p = m.probability([u for u, _ in labelled[1000:]]) > 0.5
    assert np.mean(p == np.array([b for _, b in labelled[1000:]])) > 0.95
    assert url_filter.fit([], []).probability(["http://x.org/"])[0] < 0.5


def test_url_suffix_record_does_not_hold_its_own_label():
    r = random.Random(8)
    urls = [f"http://s{k}.h{k}.com/" + ("7" * r.randint(20, 40) if k % 2 else "a" * r.randint(20, 40)) for k in range(600)]
    m = url_filter.fit(urls[:400], [k % 2 == 1 for k in range(400)])  # every host is met once: only the digits tell
    p = m.probability(urls[400:]) > 0.5
    assert np.mean(p == np.array([k % 2 == 1 for k in range(400, 600)])) > 0.97


def test_url_verdicts_equal_trees_walked_plainly(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    seeds = url_filter.seed_urls()
    m = url_filter.fit([u for u, _ in seeds], [b for _, b in seeds])

    def margin(x):
        out = m.trees.base
        for feature, cut, left, right, value in m.trees.trees:
            node = 0
            while feature[node] >= 0:
                node = int(left[node] if x[feature[node]] <= cut[node] else right[node])
            out += value[node]
        return out

    said = dict((text, v) for v, text in url_filter.RULES)
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in url_filter.report(pages).collect():
        x = url_filter.features(urls[r.page_id], m.suffixes)
        assert r.verdict == (said[r.rule] if r.rule else "block" if margin(x) > 0 else "allow")


def test_url_labels_of_a_table_hold_out_by_host(spark):
    """Labels of real pages' hosts (a chain of hyphens is blocked), learned on some hosts and measured on others."""
    pages = table(spark, "/root/testdata/sf0.1", "pages").withColumn("host", url_filter.split_url(F.col("url"))[0])
    labelled = pages.select("url", F.contains("host", F.lit("-")).alias("blocked"), (F.crc32("host") % 2 == 0).alias("learn"))
    other = labelled.where("not learn").withColumn("page_id", F.monotonically_increasing_id())
    got = url_filter.report(other, labelled.where("learn")).join(other.select("page_id", "blocked"), "page_id").where("rule is null").collect()
    assert len({r.blocked for r in got}) == 2 and np.mean([(r.verdict == "block") == r.blocked for r in got]) > 0.95


def near_copies(seed, n=60):
    r = random.Random(seed)
    words = [f"v{k}" for k in range(400)]
    out = []
    while len(out) < n:
        base = [r.choice(words) for _ in range(r.choice([3, 8, 20, 60, 150]))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(words)
            out.append((len(out) * 7 % 1009, " ".join(copy)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cross", [0, 500])
def test_jaccard_equals_all_pairs(spark, seed, cross):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(jaccard_join.join(df, cross=cross)) == sorted(jaccard_join.brute_force(rows), key=repr)
    assert rows_of(jaccard_join.join(df, k=5, num=80, den=100, cross=cross)) == sorted(jaccard_join.brute_force(rows, 5, 80, 100), key=repr)


@pytest.mark.parametrize(("num", "den"), [(85, 100), (80, 100)])
def test_linked_sets_meet_in_a_window(num, den):
    """Under any sketch, linked sets meet at their first shingle in common: in the smaller one's narrow window, in the
    other's wide one, and at places that let them link."""
    rng = np.random.default_rng(7)
    linked = 0
    for _ in range(400):
        classes = rng.integers(0, rng.integers(1, 255), jaccard_join.SLOTS if linked % 50 == 0 else 1, dtype=np.uint8)
        classes = np.resize(classes, jaccard_join.SLOTS)
        x = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 400)), dtype=np.uint64))
        out, extra = (int(len(x) * rng.uniform(0, (den - num) / den)) for _ in range(2))
        y = np.unique(np.concatenate((x[out:], rng.integers(0, 2**63, extra, dtype=np.uint64))))
        inter = len(np.intersect1d(x, y))
        if den * inter < num * (len(x) + len(y) - inter):
            continue
        linked += 1
        if len(x) > len(y):
            x, y = y, x
        (a, at), (b, bt) = jaccard_join.window(x, classes, num, den), jaccard_join.window(y, classes, num, den)
        common, i, j = np.intersect1d(a, b, True, True)
        first = np.argmin(i)
        assert len(common) and at[i[first]] & 1
        n, m, p, q = len(x), len(y), (int(at[i[first]]) & 0xFFFFFFFF) >> 1, (int(bt[j[first]]) & 0xFFFFFFFF) >> 1
        assert at[0] >> 32 == n and (num + den) * min(n - p, m - q) >= num * (n + m)
    assert linked > 100


def test_jaccard_dense_group(spark):
    """One text edited in many places, so that links are near the threshold and chains form."""
    r = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(90):
        copy = list(base)
        for _ in range(r.randint(0, 8)):
            copy[r.randrange(120)] = f"e{r.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(jaccard_join.join(df, cross=10)) == sorted(jaccard_join.brute_force(rows), key=repr)


def test_jaccard_odd_rows(spark):
    got = {r.doc_id: r for r in jaccard_join.join(clashing(odd(spark))).collect()}
    assert got[1].n_shingles == got[2].n_shingles == got[3].n_shingles == 0 and got[1].component_id == 1 and got[2].component_id == 2
    assert got[5].component_id == 4 and got[7].component_id == 6 and got[9].component_id == 8 and got[4].n_shingles == 1
    assert got[None].component_id is None
    assert jaccard_join.join(odd(spark, [])).collect() == []


def test_decontamination_equals_brute_force(spark, docs):
    items = table(spark, SF, "benchmark")
    rows, bench = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    rows += [(i, t) for i, t in ODD if i] + [(900, bench[0][1]), (901, "x " + bench[1][1].upper() + " " + bench[1][1])]
    bench += [(9001, None), (9002, ""), (9003, "one two"), (9004, "the of and"), (9005, bench[0][1])]
    rows += [(None, bench[0][1]), (None, "nothing here"), (3, bench[1][1]), (3, "clean words only")]
    bench += [(None, bench[2][1])]
    df, short = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    plain = decontaminate.brute_force(rows, bench)
    want = sorted(plain, key=repr)
    assert any(w[-1] for w in want)
    for size in (1 << 20, 30_000):
        assert rows_of(decontaminate.report(df, short, block_bytes=size)) == want
        left = decontaminate.clean(df, decontaminate.hits(df, short, block_bytes=size))
        assert rows_of(left) == sorted(((i, t) for (i, t), w in zip(rows, plain, strict=True) if not w[-1]), key=repr)
    assert decontaminate.report(odd(spark, []), items).collect() == []
    assert not any(r.contaminated for r in decontaminate.report(clashing(odd(spark)), short.limit(0)).collect())


def test_language_forward_sums_all_segmentations():
    r = np.random.default_rng(1)
    vocab = [bytes((c,)) for c in range(256)] + [b" a", b"ab", b" ab", b"bc", b"abc", b"ca", b" bca"]
    p = r.random((len(vocab), 2))
    p /= p.sum(0)
    words = [b"abcab", b"bca", b"c", "é".encode()]
    with np.errstate(over="ignore"):
        got = language_id.log_probabilities(language_id.Pieces(vocab), p, words)
    for k, w in enumerate(words):
        for lang in (0, 1):
            assert np.isclose(got[k, lang], np.log(language_id.brute_force(vocab, dict(zip(vocab, p[:, lang], strict=True)), w)))


def test_language_long_words():
    r = np.random.default_rng(2)
    vocab = [bytes((c,)) for c in range(256)] + [b" a", b"ab", b" ab", b"bc", b"abc", b"ca", b" bca", "日本".encode()]
    p = r.random((len(vocab), 2))
    p /= p.sum(0)
    pieces = language_id.Pieces(vocab)
    with np.errstate(over="ignore"):
        for w in (b"abcabca", b"bc", "日本x".encode()):
            assert np.allclose(language_id.long_word(pieces, p, w), language_id.log_probabilities(pieces, p, [w])[0])
        for lang in (0, 1):  # 501 bytes by plain sums of logs
            w, a = b" " + b"abc" * 167, [0.0]
            for end in range(1, len(w) + 1):
                terms = [a[b] + np.log(p[vocab.index(w[b:end]), lang]) for b in range(max(0, end - 6), end) if w[b:end] in vocab]
                a.append(float(np.logaddexp.reduce(terms)))
            assert np.isclose(language_id.log_probabilities(pieces, p, [w[1:]])[0, lang], a[-1])


def test_language_fit_equals_expectations_over_listed_segmentations():
    vocab = [bytes((c,)) for c in range(256)] + [b" a", b"ab", b" ab", b"bc", b"abc", b"ca"]
    sample = [("x", b"abc bca abc"), ("y", b"cab abcab"), ("x", b"ca")]

    def cuts(w):
        return [[]] if not w else [[v, *rest] for v in vocab if w.startswith(v) for rest in cuts(w[len(v) :])]

    p = {lang: dict.fromkeys(vocab, 1 / len(vocab)) for lang in "xy"}
    for _ in range(3):
        for lang in "xy":
            expected = dict.fromkeys(vocab, 0.02)
            for w in b" ".join(t for k, t in sample if k == lang).split():
                ways = cuts(b" " + w)
                weight = [np.prod([p[lang][v] for v in way]) for way in ways]
                for way, x in zip(ways, weight, strict=True):
                    for v in way:
                        expected[v] += x / sum(weight)
            p[lang] = {v: e / sum(expected.values()) for v, e in expected.items()}
    got = language_id.fit(sample, vocab, 3)
    assert got.langs == ["x", "y"]
    assert np.allclose(got.p, [[p[lang][v] for lang in "xy"] for v in vocab])


def test_long_words_and_whole_texts_are_learned(spark):
    vocab = language_id.vocabulary(queries.PIECES)
    pieces, rng = language_id.Pieces(vocab), np.random.default_rng(1)
    p = rng.random((len(vocab), 2)) + 1e-3
    word = b"thecatandthedogandthebirdinthehouse" * 2
    text = np.frombuffer(b" " + word, np.uint8).reshape(1, -1)
    with np.errstate(over="ignore"):
        edges = list(pieces.edges(text))
        a = language_id.forward(pieces, p, text, edges)
        b = np.zeros_like(a)
        b[:, -1] = 1
        for begin, end, rows, found in reversed(edges):
            b[rows, begin] += b[rows, end] * p[found]
        want = np.zeros((len(vocab), 2))
        for begin, end, rows, found in edges:
            np.add.at(want, found, (a[rows, begin] * p[found] * b[rows, end] / a[:, -1]))
        ids, g = language_id.long_expectations(pieces, np.log(p), word)
    got = np.zeros((len(vocab), 2))
    np.add.at(got, ids, g)
    assert np.allclose(got, want)
    far = spark.createDataFrame([(1, "aa " * 20_000 + "zweckverband", "de", None, None), (2, "bb", "en", None, None)], DOC)
    words, langs = language_id.sample_words(language_id.sample_of(far, "doc_id", "text", "lang", F.lit(True)))
    assert langs == {"de", "en"} and words == {("de", b"aa"): 20_000, ("de", b"zweckverband"): 1, ("en", b"bb"): 1}


def test_language_claims(spark):
    model = language_id.fit([("en", b"the cat and the dog and the bird " * 9), ("de", "der hund und die straße und der vogel ".encode() * 9)], language_id.vocabulary(queries.PIECES))
    rows = [(1, "the dog and the cat"), (2, "xqzjkvw qqxzkj zzkqxj vvxqjz"), (3, None), (4, "123"), (None, "der vogel und die Straße")]
    got = language_id.claimed(clashing(odd(spark, rows)).withColumn("score", F.lit(7)), model)
    assert {r.text for r in got.collect()} == {rows[0][1], rows[4][1]} and {r.score for r in got.collect()} == {7}
    same = spark.createDataFrame([(None, f"words of a text {k}", "en", None, None) for k in range(900)], DOC)
    assert language_id.sample_of(same, "doc_id", "text", "lang", F.lit(True), 50).count() <= 100


def test_language_hold_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.report(docs, queries.PIECES).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark):
    model = language_id.fit([("en", b"the cat and the dog"), ("de", "der hund und die straße".encode())], language_id.vocabulary(queries.PIECES))
    got = {r.doc_id: r for r in language_id.identify(clashing(odd(spark)), model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 11)] == ["und"] * 4 and got[12].lang_pred == "en" and got[10].lang_pred != "und"
    assert {r.lang_pred for r in language_id.report(odd(spark, [(4, None)]), queries.PIECES).collect()} == {"und"}
    assert language_id.report(odd(spark, []), queries.PIECES).collect() == []


def test_warc_round_trip(spark, tmp_path):
    same, small = "x" * 150, "y" * 99
    rows = [(5, "http://a/", same), (3, "http://b/ c\r\n", same), (9, None, same), (1, "u", small), (2, "u", small), (7, "v", None), (8, "v", ""), (4, "é", "ä" * 60), (6, "w", "ä" * 60), (None, "n", same), (3, "http://b/ c\r\n", same)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    bundles = warc_store.write(pages, bundle_bytes=200)
    got = rows_of(warc_store.read(bundles))
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        first = min((j for j, _, u in rows if (u or "").encode() == b and j is not None), default=i)
        again = len(b) >= 100 and i is not None and i > first
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)
    for r in bundles.collect():
        for x in r["index"]:
            headers, _ = warc_store.fetch(bytes(r.data), x["frame"], x["offset"])
            assert headers["WARC-Record-ID"] == f"<urn:page:{'' if x['id'] is None else x['id']}>"
        places = [(x["id"], x["frame"], x["offset"]) for x in r["index"]]
        for k in range(len(places)):
            with pytest.raises(ValueError):
                list(warc_store.records(bytes(r.data), places[:k] + places[k + 1 :]))
    files = warc_store.export(bundles, str(tmp_path)).collect()
    assert files and all(warc_store.seek_table(open(f.path, "rb").read()) for f in files)
    assert warc_store.round_trip(pages.limit(0)).collect() == []


def test_quality_statistics(spark, docs):
    both = docs.select("doc_id", "text").union(odd(spark).select("doc_id", "text")).union(spark.createDataFrame([(77, "a b c a b c x\na b\na b\n\n \n\n"), (78, "q q q q q #$%"), (79, "α\u2003β α\u2003β")], "doc_id long, text string"))
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for bits in (quality_rules.PLACE, 2, 61):  # as it is, more words than places, hashes of 3 bits that clash
        got = quality_rules.statistics(clashing(both if bits == quality_rules.PLACE else both.where("length(text) < 20000 or text is null")), "text", ["text"], bits).collect()
        assert bits != quality_rules.PLACE or len(got) == both.count()
        for r in got:
            assert tuple(r[c] for c in cols) == quality_rules.brute_force(r.text), (bits, r.text)


def test_quality_rules(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = quality_rules.report(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in got]) > 0.95
    plain = quality_rules.report(clashing(odd(spark)), labels.limit(0))
    assert sorted(r.kept for r in plain.collect()) == sorted(n >= 50 and 2 * again <= n for n, _, _, _, again in (quality_rules.brute_force(t) for _, t in ODD))
    assert quality_rules.report(odd(spark, []), labels).collect() == []


def test_quality_verdict_equals_the_list_in_plain_code(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rules, texts = quality_rules.train(docs, labels), {r.doc_id: r.text for r in docs.collect()}
    assert rules
    for r in quality_rules.report(docs, labels).collect():
        text = texts[r.doc_id] or ""
        n, chars, symbols, dup, again = quality_rules.brute_force(text)
        lines = sum(bool(regex.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
        share = lambda a, b: a / max(b, 1)
        x = {
            "words": n, "mean_word": share(chars, n), "symbol_share": share(symbols, chars), "dup_line_share": share(dup, lines), "repeat_share": share(again, n),
            "mark_share": share(text.count("!") + text.count("?"), n), "capital_share": share(sum("A" <= c <= "Z" for c in text), chars),
        }
        holds = any(all((x[t.feature] > t.threshold) == t.above for t in rule) for rule in rules)
        failed = n < 50 or 100 * again > 50 * n
        assert (r.base_failed, r.kept) == (failed, not failed and not holds)


def test_lm_scores(spark):
    docs = [(k, "cats like warm milk and sleep" if k % 2 else "stocks fell on weak bond yields") for k in range(40)] + [(100, None), (101, "")]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1, 20, 2)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lm_scores.report(clashing(spark.createDataFrame(docs, "doc_id long, text string")), labels).collect()}
    assert got[21].difference < 0 < got[22].difference and got[100].n_tokens == got[101].n_tokens == 0 and got[100].difference == 0
    assert lm_scores.report(odd(spark, []), labels).collect() == []
    words, pairs = lm_scores.Slots()(b"a b a b c")
    counts = np.zeros(lm_scores.WORD_SLOTS + lm_scores.PAIR_SLOTS, np.float32)
    np.add.at(counts, words, 1)
    np.add.at(counts, lm_scores.WORD_SLOTS + pairs, 1)
    one = [(counts[w] + 1) / (5 + lm_scores.WORD_SLOTS) for w in words]
    p = [one[0]] + [0.7 * counts[lm_scores.WORD_SLOTS + q] / counts[v] + 0.3 * x for q, v, x in zip(pairs, words[:-1], one[1:], strict=True)]
    assert np.isclose(lm_scores.losses(counts, words, pairs), -np.log(p).mean())


def test_lm_scores_count_every_word_and_pair_for_itself(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(f"W{int(rng.paretovariate(0.1)) % 10**6}" for _ in range(400))) for k in range(300)] + [(None, "w1 w1 w2"), (None, "w1 w1 w2"), (7, "w1"), (8, None)]
    labels = [(k, 1, 0) for k in range(0, 60, 2)]
    counts = [(Counter(), Counter()), (Counter(), Counter())]
    for k, text in docs:
        words = (text or "").lower().split()
        for c, use in zip(counts, (True, k in range(0, 60, 2)), strict=True):
            if use:
                c[0].update(words)
                c[1].update(zip(words, words[1:]))
    assert len(counts[0][0]) > lm_scores.WORD_SLOTS / 2  # so that many words would share a hashed slot
    size, wanted = counts[0][0].total(), counts[1][0].total()
    want = []
    for k, text in docs:
        words, both = (text or "").lower().split(), []
        for (single, pair), scale in ((counts[1], 1), (counts[0], wanted / size)):
            p = [(single[w] * scale + 1) / (wanted + len(counts[0][0])) for w in words]
            p[1:] = [0.7 * (pair[v, w] / single[v] if single[v] else 0) + 0.3 * x for v, w, x in zip(words, words[1:], p[1:])]
            both.append(float(-np.log(p).mean()) if p else 0.0)
        want.append((str(k), len(words), *both, both[0] - both[1]))
    for size in (1 << 24, 100_000):
        got = lm_scores.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), slice_bytes=size).collect()
        got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in got)
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
        assert np.allclose([g[2:] for g in got], [w[2:] for w in sorted(want)], atol=1e-9)


PAGE = "<html><head><title>T{0}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li>Menu</li></ul></nav><div class='ad'>Buy {0}</div><article><h1>Head {0}</h1><p>Some <b>bold</b>\n  text {0} &amp; more<br><p>Second &eacute; {0}</article><div class='comments'><p>First! {0}</p></div><form>Name <input></form><aside>Side</aside><footer>&copy; Site</footer></body></html>"


def test_html_main_text():
    got = html_text.extract([PAGE.format(k) for k in range(3)])
    assert got == [f"Head {k}\n\nSome bold text {k} & more\n\nSecond é {k}" for k in range(3)]
    bare = "<body><div>Welcome to Site</div><div><p>Body {0} text</p><p>Common line</p></div><div>All rights reserved</div></body>"
    varied = html_text.extract([bare.format(k) for k in "abc"])
    assert varied[0].startswith("Body a text") and "Welcome" not in varied[0] and "rights" not in varied[0]
    assert html_text.extract([None, "", "plain <unclosed", "<p>a<!-- x", "<div>" * 3000 + "deep"])[:2] == ["", ""]
    assert html_text.align("a(b(),c(),d())", "a(b(),d())") == {0: 0, 1: 1, 3: 2}


def test_html_hard_pages():
    assert html_text.extract(["<main>" * 400 + "<p>Deep</p>" + "</main>" * 400]) == ["Deep"]
    assert html_text.extract(["<article class='post share'><p>Own</p></article><article class='comment'><p>Theirs</p></article>"]) == ["Own"]
    wide = "<body><div>Site</div><article>" + "<p>{0} a</p><h2>{0}</h2>" * 3000 + "</article></body>"
    got = html_text.extract([wide.format(k) for k in range(3)] + [wide.format(9).replace("<h2>9</h2>", "<ul><li>9</li></ul>", 1500)])
    assert all(t.count("\n\n") == 5999 for t in got)
    r = random.Random(3)

    def grow(level):
        return r.choice("abc") + "(" + ",".join(grow(level - 1) for _ in range(r.randint(0, 4) if level else 0)) + ")"

    def best(x, y):  # simple tree matching by its definition
        if x[0] != y[0]:
            return 0
        m = [[0] * (len(y[2]) + 1) for _ in range(len(x[2]) + 1)]
        for i, p in enumerate(x[2]):
            for j, q in enumerate(y[2]):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + best(p, q))
        return m[-1][-1] + 1

    for _ in range(300):
        one, other = grow(3), grow(3)
        pairs = html_text.align(one, other)
        assert len(pairs) == best(html_text._tree(one), html_text._tree(other)) == len(set(pairs.values()))


def test_html_table(spark):
    pages = spark.createDataFrame([(k, f"http://h{k % 2}.org/{k}", PAGE.format(k)) for k in range(70)] + [(100, None, None), (101, "x", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_text.report(clashing(pages)).collect()}
    assert len(got) == 72 and got[7].text == "Head 7\n\nSome bold text 7 & more\n\nSecond é 7" and got[7].n_chars == len(got[7].text) and got[100].text == ""
    assert html_text.report(pages.limit(0)).collect() == []


def test_html_copies_are_no_template(spark):
    plain = "<body><div>Welcome to Site</div><div><p>Body {0} text</p></div></body>"
    table = "<body><div>Welcome to Site</div><table><tr><td>Cell text</td></tr></table></body>"
    pages = [plain.format(k) for k in range(30)] + [table] * 2
    want = [f"Body {k} text" for k in range(30)] + ["Cell text"] * 2
    assert html_text.extract(pages) == want
    assert html_text.extract([table] * 40 + pages[:30]) == ["Cell text"] * 40 + want[:30]
    rows = [(k, f"http://h.org/{k}", p) for k, p in enumerate([table] * 40 + pages[:30])]
    got = html_text.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in sorted(got, key=lambda r: r.page_id)] == ["Cell text"] * 40 + want[:30]


def test_html_wrapper_decides_in_marked_pages():
    page = "<body><article><h1>Head {0}</h1><div><p>All rights <b>reserved</b></p></div><section>Body {0}</section></article></body>"
    assert html_text.extract([page.format(k) for k in range(4)]) == [f"Head {k}\n\nBody {k}" for k in range(4)]
    line = "<body><article><p>Text {0} <b><i>bold</i></b> words</p></article></body>"
    assert html_text.extract([line.format(k) for k in range(4)]) == [f"Text {k} bold words" for k in range(4)]
    assert html_text.extract([f"<body><article>Same</article><div>Other {k}</div></body>" for k in range(4)]) == ["Same"] * 4
    assert html_text.extract(["<body><main><p>Own text</p><article>Story</article></main></body>"]) == ["Own text\n\nStory"]
    assert html_text.extract(["<body><main><nav>Menu</nav><article>Story</article></main></body>"]) == ["Story"]


def test_token_counts(spark):
    e = token_counts.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in queries.token_counts.token_counts(clashing(odd(spark)), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    for i, t in ODD:
        assert got[i].n_tokens == len(e.encode(t or "")) == sum(got[i].section_tokens)
    def split(t):
        ids, at = [], 0
        for m in regex.finditer(public_tokenizers.PATTERN, t):
            assert m.start() == at
            at = m.end()
            ids += e.encoding._encode_single_piece(m[0])
        return ids

    for t in (" " * 600, "a" + " " * 600 + "b", "\n" * 700 + "x", "x" + "\u3000" * 501, "a" + " \n" * 400 + "é" + " " * 499 + "z"):
        assert e.encode(t) == split(t) == e.encoding.encode_ordinary(t), t[:5]
    assert len(e.encode("a" + "\n" * 2_000_000 + "b")) > 1000
    given = spark.createDataFrame([(1, "abc def ghi", [4, 4, None, 99, 2]), (2, "abc", None), (3, "abc", [2])], "doc_id long, text string, starts array<int>")
    parts = {r.doc_id: (r.n_sections, r.n_tokens, sum(r.section_tokens)) for r in token_counts.token_counts(given, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, starts_col="starts").collect()}
    assert parts[1][0] == 3 and parts[2][0] == 1 and parts[3][0] == 2 and all(n == t for _, n, t in parts.values())
    ends, widths = np.array([3, 8, 10]), np.array([3, 5, 2])
    starts = np.array([0, 4, 6])
    assert [list(token_counts.allocate(ends, widths, starts, rule)[0]) for rule in token_counts.RULES] == [[1, 1, 1], [2, 0, 1], [1, 0, 2]]


def test_token_counts_equal_bytes_counted_one_by_one(spark, docs):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    e = token_counts.encoder(ranks, public_tokenizers.PATTERN).encoding
    texts = {r.doc_id: r.text for r in docs.collect()}
    for rule in token_counts.RULES:
        for r in token_counts.token_counts(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN, rule).collect():
            line, want, crossing, n = 0, Counter(), 0, 0
            for token in e.encode_ordinary(texts[r.doc_id] or ""):
                over = Counter()
                for byte in e.decode_single_token_bytes(token):
                    over[line] += 1
                    line += byte == 10
                n, crossing = n + 1, crossing + (len(over) > 1)
                want[max(over) if rule == "last" else min(over) if rule == "first" else min(over, key=lambda k: (-over[k], k))] += 1
            assert (r.n_tokens, r.n_crossing) == (n, crossing)
            assert r.section_tokens == [want[k] for k in range(r.n_sections)] and sum(want.values()) == sum(r.section_tokens)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.select(*names)) == sorted(want.fetchall(), key=repr)
