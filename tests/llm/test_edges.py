"""Empty tables and very long rows of the operators that read pages or encode texts."""

import hashlib

import public_tokenizers

from rollcall.llm import html_text, language_id, queries, sentencepiece_codec, token_counts, url_filter, warc_store

from .test_operators import clashing, odd

PAGE = "page_id long, url string, html string"
LONG = "lease of land " * 150_000  # over two million characters


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGE)


def test_empty_tables(spark):
    none = odd(spark, [])
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert sentencepiece_codec.encode_digests(none, "doc_id", "text", queries.PIECES).collect() == []
    assert token_counts.token_counts(none, "doc_id", "text", ranks, public_tokenizers.PATTERN).collect() == []
    empty = pages(spark).limit(0)
    assert url_filter.report(empty).collect() == [] and warc_store.round_trip(empty).collect() == [] and html_text.report(empty).collect() == []
    assert language_id.report(none, queries.PIECES).collect() == []


def test_very_long_pages(spark):
    url = "http://example.org/" + "a/" * 100_000 + "?q=" + "1" * 100_000
    rows = [(1, url, f"<html><body><article><p>{LONG}</p></article></body></html>"), (2, url, f"<html><body><article><p>{LONG}</p></article></body></html>"), (3, None, None)]
    df = clashing(pages(spark, *rows))
    judged = {r.page_id: r for r in url_filter.report(df).collect()}
    assert judged[1].path == "/" + "a/" * 100_000 and judged[1].verdict == judged[2].verdict and judged[3].host == ""
    kept = {r.page_id: r for r in warc_store.round_trip(df).collect()}
    assert kept[1].payload_digest == hashlib.sha256(rows[0][2].encode()).hexdigest() and kept[2].refers_to == 1 and kept[3].payload_bytes == 0
    texts = {r.page_id: r.text for r in html_text.report(df).collect()}
    assert texts == {1: LONG.strip(), 2: LONG.strip(), 3: ""}


def test_a_very_long_text_is_encoded_whole(spark):
    import sentencepiece

    text = LONG[:400_000]
    got = sentencepiece_codec.encode_digests(odd(spark, [(1, text), (1, text)]), "doc_id", "text", queries.PIECES).collect()
    ids = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES).encode(text)
    assert [(r.n_tokens, r.ids_sha256) for r in got] == [(len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())] * 2
