"""MPEG audio, HTML extraction and quality scores."""

import os

import numpy as np
import pytest

from layoutlake.llm import html_text, mpeg_audio, quality


@pytest.mark.parametrize("n", [64, 128, 1408, 1472, 64 * 100])
def test_media_round_trip(n):
    payload = os.urandom(n)
    media = mpeg_audio.encode_media(payload)
    stream = mpeg_audio.parse(media)
    assert mpeg_audio.read_payload(media, stream) == payload
    assert stream.table["frames"] == len(stream.offsets) == stream.crc_checked and not stream.crc_wrong
    assert stream.samples == 1152 * len(stream.offsets) and len(stream.seek) == 100


def test_parser_survives_damage():
    media = bytearray(mpeg_audio.encode_media(os.urandom(64 * 400)))
    clean = mpeg_audio.parse(bytes(media))
    media[clean.offsets[3] + 8] ^= 1
    assert mpeg_audio.parse(bytes(media)).crc_wrong == 1
    del media[clean.offsets[6] + 100 : clean.offsets[6] + 110]
    hurt = mpeg_audio.parse(b"junk" + bytes(media) + b"TAG" + bytes(125))
    assert hurt.skipped and len(hurt.offsets) >= len(clean.offsets) - 3
    assert mpeg_audio.parse(b"").samples == 0 and mpeg_audio.parse(b"\xff" * 50).samples == 0
    assert mpeg_audio.parse(bytes(media)[: clean.offsets[5] + 7]).cut
    with pytest.raises(ValueError):
        mpeg_audio.read_payload(bytes(media), mpeg_audio.parse(bytes(media)))


def test_other_layers():
    h = mpeg_audio.read_header(bytes((0xFF, 0xFD, 0x80, 0xC0)), 0)  # MPEG-1 Layer II, 128 kbit/s, 44.1 kHz, mono
    assert (h.layer, h.bit_rate, h.sample_rate, h.channels, h.samples, h.size) == (2, 128000, 44100, 1, 1152, 417)
    h = mpeg_audio.read_header(bytes((0xFF, 0xF3, 0x80, 0xC0)), 0)  # MPEG-2 Layer III, 64 kbit/s, 22.05 kHz
    assert (h.layer, h.bit_rate, h.sample_rate, h.samples, h.size, h.side) == (3, 64000, 22050, 576, 208, 9)


def test_media_query_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "abc"), (4, "abc")], "doc_id long, text string")
    out = {r.doc_id: r for r in mpeg_audio.from_media(mpeg_audio.to_media(df)).collect()}
    assert out[1].payload_bytes == 64 and out[1].media_sha256 == out[2].media_sha256 and out[3].feature == out[4].feature


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/x">Home</a></nav>
<div class="cookie-notice">We use cookies to make this site better for all of you who read it here</div>
<article><header><h1>Head   line</h1></header><p>A &lt; b &amp;amp; <a href='x>y'>link</a> and more words to read.<p>Second<form><label>Mail</label></form>
<section id="comments"><p>I like it very much indeed, thanks for writing</p></section><p>Last one</article><aside><p>Side text that nobody asked for in this place</p></aside><footer>foot</footer></body>"""


def test_html():
    assert html_text.main_text(PAGE) == "Head line\nA < b &amp; link and more words to read.\nSecond\nLast one"
    for page in (None, "", "<", "<a", "<!-- x", "</p>", "<script>x", "<p"):
        assert html_text.main_text(page) == ""


def test_tree_learns_its_table_and_obeys_hints():
    tree = html_text.tree()
    assert all(tree.says(r) == bool(r[-1]) for r in html_text.LABELLED)
    assert not any(tree.says((w, d, -1, 50, 0.0, 50, 0.0)) for w in (1, 20, 60, 300) for d in (0.0, 0.3, 1.0))


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (2, None, PAGE, "y")], "page_id long, url string, html string, text string")
    out = {r.page_id: r for r in html_text.extract(df).collect()}
    assert out[1].text == "" and out[1].n_chars == 0 and out[2].n_chars == len(out[2].text)


def test_quality_learns_form(spark):
    good = [f"The river ran past {w} and the people of the town went on with their work in peace." for w in ("mills", "farms", "bridges", "gardens", "houses", "hills") for _ in range(5)]
    bad = [f"{w.upper()}!! BUY!! NOW!! {w.upper()}!! CHEAP!! " * 6 for w in ("pill", "watch", "loan", "prize", "ticket", "bonus") for _ in range(5)]
    x = np.array([quality.features(t) for t in good + bad])
    model = quality.fit(x, np.array([1] * 30 + [0] * 30))
    s = model.score(np.array([quality.features(t) for t in ("The people of the village walked along the river in the evening.", "WIN!! CASH!! NOW!! WIN!! CASH!! NOW!!", "", None)]))
    assert s[0] > 0.9 and s[1] < 0.1 and s[2] == s[3] == 0.5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad + [None, ""])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality.score(docs.withColumn("score", docs.doc_id), quality.train(docs, labels)).collect()
    assert len(out) == 62 and all((r.score > 0.5) == (r.doc_id < 30) for r in out if r.doc_id < 60)
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
