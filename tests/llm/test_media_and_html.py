import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import flac
from tidemark.llm.flac import CorruptMedia, media_digest, pcm_blocks, read_streams, to_media, write_streams
from tidemark.llm.html_text import html_text, render


def payloads():
    rng = np.random.default_rng(0)
    n = flac.SIZE
    return [
        rng.integers(0, 256, n * 5, dtype=np.uint8).tobytes(), bytes(n * 3), (128 + 60 * np.sin(np.arange(n * 300) / 20)).astype(np.uint8).tobytes(),
        np.where(rng.random(n * 4) < 0.003, 255, 128).astype(np.uint8).tobytes(), bytes([127] * n * 130), np.resize(np.arange(256, dtype=np.uint8), n * 2).tobytes(), b"\xff" * n,
    ]


def test_streams_round_trip():
    media = write_streams(payloads())
    assert read_streams(media) == payloads() and [read_streams([m])[0] for m in media] == payloads()
    assert len(media[1]) < 300 and len(media[2]) < 0.3 * len(payloads()[2])


def test_long_codes_round_trip():
    x = np.full(flac.SIZE * 2, 128, np.uint8)
    x[[50, 700]] = 0, 255
    assert read_streams(write_streams([x.tobytes()])) == [x.tobytes()]


def test_every_flipped_bit_is_noticed():
    (m,) = write_streams([payloads()[3]])
    start = 4 + 38 + 4 + 18 * 4
    for at in range(start, len(m), 37):
        bad = bytearray(m)
        bad[at] ^= 1 << at % 8
        with pytest.raises(CorruptMedia):
            read_streams([bytes(bad)])
    with pytest.raises(CorruptMedia):
        read_streams([b"RIFF" + m[4:]])


def test_checksums_and_frame_numbers():
    data = np.frombuffer(b"123456789", np.uint8)
    assert flac.crc16(data, np.array([0]), np.array([9]))[0] == 0xFEE8 and flac.crc8(data, np.array([0]), np.array([9]))[0] == 0xF4
    assert [flac._frame_number(n).hex() for n in (0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)] == ["7f", "c280", "dfbf", "e0a080", "efbfbf", "f0908080"]


def test_media_rows(odd, none, plain):
    rows = media_digest(to_media(odd)).collect()
    want = []
    for i, t in plain:
        b = (t or "").encode()
        p = b + b"\xff" * (-len(b) % 576 or (0 if b else 576))
        want.append((str(i), len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        assert by.setdefault(r["payload_sha256"], (r["media_sha256"], r["media_bytes"], r["feature"])) == (r["media_sha256"], r["media_bytes"], r["feature"])
        offsets = b"".join(struct.pack("<QQ", at, min(16 * 576, r["payload_bytes"] - at)) for at in range(0, r["payload_bytes"], 16 * 576))
        assert (r["n_blocks"], r["blocks_crc32"]) == (-(-r["payload_bytes"] // (16 * 576)), zlib.crc32(offsets))
    assert media_digest(to_media(none)).count() == 0
    (gone,) = media_digest(to_media(odd.where("doc_id = 3")).withColumn("media", F.lit(None).cast("binary"))).collect()
    assert gone["doc_id"] == 3 and gone["n_bytes"] > 0 and all(gone[c] is None for c in gone.asDict() if c not in ("doc_id", "n_bytes"))


def test_pcm_blocks_have_offsets(spark, odd):
    media = to_media(odd.where("doc_id = 39"))
    blocks = sorted(pcm_blocks(media, 2).collect(), key=lambda r: r["sample_offset"])
    assert [r["sample_offset"] for r in blocks] == [i * 1152 for i in range(len(blocks))] and all(len(r["pcm"]) == r["n_samples"] for r in blocks)
    text = odd.where("doc_id = 39").first()["text"].encode()
    assert b"".join(r["pcm"] for r in blocks)[: len(text)] == text
    assert pcm_blocks(spark.createDataFrame([(1, None)], "doc_id long, media binary")).count() == 0


class Writer:
    """A plain bit by bit writer of FLAC frames, of forms that the fast writer doesn't use."""

    def __init__(self):
        self.bits = ""

    def put(self, value, width):
        self.bits += format(value & (1 << width) - 1, f"0{width}b") if width else ""

    def rice(self, residuals, method, parameter, partitions=0):
        self.put(method, 2)
        self.put(partitions, 4)
        span = flac.SIZE >> partitions
        order = flac.SIZE - len(residuals)
        at = 0
        for i in range(1 << partitions):
            part = residuals[at : at + span - (order if i == 0 else 0)]
            at += len(part)
            k = parameter[i % len(parameter)]
            if k < 0:  # escaped, -k - 1 bits a number
                self.put((1 << 4 + method) - 1, 4 + method)
                self.put(-k - 1, 5)
                for v in part:
                    self.put(v, -k - 1)
                continue
            self.put(k, 4 + method)
            for v in part:
                u = 2 * v if v >= 0 else -2 * v - 1
                self.bits += "0" * (u >> k) + "1"
                self.put(u, k)

    def bytes(self):
        bits = self.bits + "0" * (-len(self.bits) % 8)
        return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def plain_crc(data, width, poly):
    c = 0
    for b in data:
        c ^= b << width - 8
        for _ in range(8):
            c = (c << 1 ^ poly if c >> width - 1 else c << 1) & (1 << width) - 1
    return c


def frame(number, subframe):
    head = b"\xff\xf8\x20\x02" + flac._frame_number(number)
    body = head + bytes([plain_crc(head, 8, 0x07)]) + subframe
    return body + plain_crc(body, 16, 0x8005).to_bytes(2)


def stream(samples, frames):
    pcm = b"".join(bytes(v & 0xFF for v in s) for s in samples)
    info = bytes.fromhex("02400240") + bytes(6) + (8000 << 44 | 7 << 36 | len(pcm)).to_bytes(8) + hashlib.md5(pcm).digest()
    seek, at = b"", 0
    for i, f in enumerate(frames):
        seek += (i * flac.SIZE).to_bytes(8) + at.to_bytes(8) + flac.SIZE.to_bytes(2)
        at += len(f)
    return b"fLaC\x00" + len(info).to_bytes(3) + info + b"\x83" + len(seek).to_bytes(3) + seek + b"".join(frames), bytes(v & 0xFF ^ 0x80 for v in pcm)


def coded(samples, kind, wasted, method, parameter, partitions, precision=0, shift=0, c=()):
    w, depth = Writer(), 8 - wasted
    x = [v >> wasted for v in samples]
    w.put(kind << 1 | (wasted > 0), 8)
    if wasted:
        w.put(1, wasted)
    if kind == 0:
        w.put(x[0], depth)
    elif kind == 1:
        for v in x:
            w.put(v, depth)
    else:
        order = kind - 31 if kind >= 32 else kind - 8
        for v in x[:order]:
            w.put(v, depth)
        if kind >= 32:
            w.put(precision - 1, 4)
            w.put(shift, 5)
            for v in c:
                w.put(v, precision)
        else:
            c = flac.FIXED[order]
        w.rice([x[i] - (sum(c[j] * x[i - 1 - j] for j in range(order)) >> shift) for i in range(order, flac.SIZE)], method, parameter, partitions)
    return w.bytes()


def test_all_forms_of_frames_are_read():
    rng = random.Random(4)
    wave = [round(90 * np.sin(i / 9)) + rng.randint(-3, 3) for i in range(flac.SIZE)]
    forms = [
        (wave, 9, 0, 0, [3], 0), (wave, 10, 0, 1, [4], 0), (wave, 10, 0, 1, [20], 1), (wave, 9, 0, 0, [3, -8, 2, -9], 4), (wave, 8, 0, 0, [-9], 0), (wave, 12, 0, 1, [-13, 5], 3),
        ([v & ~3 for v in wave], 9, 2, 0, [3], 2), ([v & ~7 for v in wave], 1, 3, 0, [0], 0), ([64] * flac.SIZE, 0, 6, 0, [0], 0), ([0] * flac.SIZE, 8, 0, 0, [-1], 0),
        (wave, 33, 0, 0, [4], 0, 9, 6, (100, -40)), (wave, 33, 0, 0, [3], 2, 12, 8, (400, -150)), (wave, 33, 0, 1, [-12, 3], 1, 7, 4, (25, -10)), ([v & ~1 for v in wave], 34, 1, 0, [5], 0, 15, 10, (900, 100, -20)),
        (wave, 1, 0, 0, [0], 0), (wave, 8, 0, 0, [0], 0),
    ]
    frames = [frame(i, coded(*f)) for i, f in enumerate(forms)]
    data, want = stream([f[0] for f in forms], frames)
    one, two = read_streams([data, data])
    assert one == two == want
    for at in (60, 200, len(data) - 40, len(data) - 1):
        broken = bytearray(data)
        broken[-at if at < 100 else at] ^= 4
        with pytest.raises((CorruptMedia, ValueError, IndexError)):
            read_streams([bytes(broken)])


CASES = {
    "<p>One<p>Two <b>three</b>\n four": "One\n\nTwo three four",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "<ul><li>a<li>b<ol start=3><li>x</li><li>y</ol><li>c</ul>": "- a\n- b\n  3. x\n  4. y\n- c",
    "<table><tr><th>Name<th>Qty<tr><td>Apple &amp; pear<td>3</table>": "Name          Qty\nApple & pear  3",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide wide wide<tr><td>a<td>b</table>": "wide wide wide\na  b",
    "<table><tr><td>x<table><tr><td>in<td>ner</table><td>y</table>": "x        y\n\nin  ner",
    "<pre>\n  a\n   b</pre>c": "  a\n   b\n\nc",
    "<title>t</title><script>x</script><style>y</style><p hidden>z<p style='display: none'>w<p>v": "v",
    "<div style='visibility:hidden'>a</div><input type=hidden value=b><input type=submit value=Go>": "Go",
    "<!-- a <b> --><!doctype html>x<!-- open": "x",
    "<dl><dt>T<dd>D</dl>": "T\n    D",
    "<h1>A</h1>b": "A\n\nb",
    "1 < 2 &amp;&lt; 3": "1 < 2 &< 3",
    "</p></div>a</b>": "a",
    "<a href='x>y'>z</a>": "z",
    "<td>loose": "loose",
    "<select><option>a<option>b</select>": "a\nb",
    "<details><summary>s</summary>more</details><details open><summary>t</summary>all</details>": "s\nt\nall",
    "<dialog>closed</dialog><dialog open>open</dialog>": "open",
    "<div style='visibility:hidden'>a<p style='visibility: visible'>b</p>c</div>d": "b\n\nd",
    "<style>.x, #y { display:none } p.z{visibility:hidden} @media print{b{display:none}} /* i{display:none} */</style><i class='w x'>a</i><i id=y>b</i><p class=z>c</p><b>d</b><i>e</i>": "de",
    "<style>p{display:none} p.k{display:block}</style><p>a<p class=k>b": "b",
    "<table><tr><td colspan=2000>a<td>b<tr><td rowspan=99999>c<td>d<tr><td>e</table>": "a     b\nc  d\n   e",
    "a<b": "a",
    "x <y z": "x",
    "<p title=\"open>a<b>c": "ac",
    "&#99999999999999999999;x": "\ufffdx",
    "": "",
}


@pytest.mark.parametrize("html", CASES)
def test_rendering(html):
    assert render(html) == CASES[html]


SOUPS = ["<a", "<a '>' ", "<a \"", "<a '' ", "</a ", "<!--", "<!-- -", "<!", "<?x", "</script ", "<script></script ", "<b></i>", "<table><td><b></i>", "&#9", "<p>", "<li>", "<ul><li>x", "<b>x</b>", "<td rowspan=9 colspan=9>", "<tr><td>", "<a x", "= ", "<style>a{", "<style>}", "<p class=a>", "<div style='display:", "<font color=\"", "'", '"', "<", ">", "</", "<table>"]


@pytest.mark.parametrize("soup", SOUPS)
def test_soup_is_read_in_linear_time(soup):
    for page in (soup * 50_000, "<i>" + soup * 20_000 + ">", "<script>" + soup * 20_000):
        began = time.process_time()
        render(page)
        assert time.process_time() - began < 5


def test_mixed_soup_is_read_in_linear_time():
    rng = random.Random(3)
    for _ in range(20):
        page = "".join(rng.choices(SOUPS, k=20_000))
        began = time.process_time()
        render(page)
        assert time.process_time() - began < 5


def page_of(rng, words, shown, deep=0):
    """A random page and, in order, the words that it shows."""
    html, want = [], []
    for _ in range(rng.randint(1, 5)):
        kind = rng.choice(["text", "block", "inline", "list", "table", "hide", "again", "raw", "details"]) if deep < 5 else "text"
        inner, seen = page_of(rng, words, shown, deep + 1) if kind not in ("text", "raw") else ("", [])
        own = [rng.choice(words) + str(rng.randrange(1000)) for _ in range(rng.randint(1, 6))]
        if kind == "text":
            html.append(" ".join(own) + rng.choice([" ", "\n", " <!-- no --> ", "<br>"]))
            want += own if shown else []
        elif kind == "block":
            html.append(rng.choice(["<div>{}</div>", "<p>{}</p>", "<h2>{}</h2>", "<section><article>{}</article></section>", "<blockquote>{}</blockquote>"]).format(inner))
            want += seen
        elif kind == "inline":
            html.append(rng.choice([" <b>{}</b> ", " <a href='x>y'>{}</a> ", ' <span class="c">{}</span> ']).format(inner))
            want += seen
        elif kind == "list":
            more, also = page_of(rng, words, shown, deep + 1)
            html.append(f"<ul><li>{inner}<li>{more}</ul>")
            want += seen + also
        elif kind == "table":
            html.append(f"<table><tr><td>{inner}</table>")
            want += seen
        elif kind == "hide":
            html.append(rng.choice(["<div hidden>{}</div>", "<div style='color:red; display:none'>{}</div>", "<dialog>{}</dialog>", "<div class='gone'>{}</div>"]).format(inner))
        elif kind == "again":
            inner, seen = page_of(rng, words, True, deep + 1)
            html.append(f"<div style='visibility:hidden'>{own[0]}<div style='visibility:visible'>{inner}</div></div>")
            want += seen
        elif kind == "raw":
            html.append(rng.choice(["<script>{}</script>", "<style>{}</style>", "<template>{}</template>"]).format(" ".join(own)))
        else:
            html.append(f"<details><summary>{own[0]}</summary>{inner}</details><details open>{own[-1]}</details>")
            want += [own[0], own[-1]] if shown else []
    return "".join(html), want


def test_the_words_of_random_pages_are_those_shown_in_their_order():
    rng = random.Random(11)
    for _ in range(400):
        html, want = page_of(rng, ["alpha", "beta", "gamma"], True)
        got = re.findall(r"(?:alpha|beta|gamma)[0-9]+", render("<style>.gone{display:none}</style>" + html))
        assert got == want


def test_deep_and_long_pages_and_rows(spark):
    assert render("<div>" * 50_000 + "x") == "x" and render("<ul><li>" * 300 + "x") == " " * 78 + "- x"
    assert len(render("<p>word " * 20_000)) > 100_000
    pages = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "<b>x</b>", 0), (2, "", 0)], "page_id long, html string, text int")
    assert sorted((str(r[0]), r[1], r[2]) for r in html_text(pages).collect()) == [("1", 0, ""), ("2", 0, ""), ("2", 0, ""), ("None", 1, "x")]
    assert html_text(pages.limit(0)).count() == 0
