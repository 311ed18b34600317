import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import zlib
from urllib.parse import quote

import pytest

from spanwatch.llm import secrets

SECRET = 'password = "hunter2hunter2"'


def encoded(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


@pytest.mark.parametrize("inner", [
    encoded(SECRET), encoded(gzip.compress(SECRET.encode())), encoded(zlib.compress(SECRET.encode())),
    encoded(encoded(quote(SECRET, safe=""))), quote(quote(SECRET, safe=""), safe=""),
    "".join("%%%02X" % ord(c) for c in SECRET), "".join("\\u%04x" % ord(c) for c in SECRET),
    "".join("&#%d;" % ord(c) for c in SECRET), encoded(gzip.compress(gzip.compress(SECRET.encode()))),
    encoded("".join("\\x%02x" % ord(c) for c in encoded(SECRET))),
])
def test_layers_are_unwrapped_and_spans_map_back(inner):
    text = "é before " + inner + " after"
    found = secrets.all_spans(text)
    assert found.spans and found.depth >= 1
    for start, kind, end in found.spans:
        assert kind == 0 and 9 <= start < end <= 9 + len(inner)


def test_wrapped_base64():
    text = "x " + base64.encodebytes(("some filler words " * 9 + SECRET).encode()).decode()
    assert any(end - start > 76 for start, _, end in secrets.all_spans(text).spans)


def test_a_partly_escaped_secret_spans_its_own_place():
    text = "a pass%77ord=abcdefgh b"
    assert secrets.all_spans(text).spans == {(2, 0, 21)}


def test_cycles_and_deep_escapes_end():
    begin = time.time()
    assert secrets.all_spans("%" + "25" * 20_000 + "41").depth >= 1
    assert not secrets.all_spans(encoded("nothing here at all, only words")).spans
    assert time.time() - begin < 20


def test_a_bomb_is_reported():
    bomb = encoded(zlib.compress(b"a" * (secrets.MAX_OUTPUT + 10), 9))
    assert secrets.all_spans(bomb).unread == 1


def test_base_rules(make_docs, odd_rows):
    access, hexa = "AKIA" + "A1" * 8, "0123456789abcdef" * 2
    text = f"API_KEY: 'abc.def' tokens token=short secret:{'x' * 6} {access} AKIAAAAA {hexa} 12345 Token=a"
    rows = odd_rows + [(70, text)]
    got = {r["doc_id"]: r for r in secrets.find_secrets(make_docs(rows, ("spans", "layers"))).collect()}
    want = []
    assign = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    want += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    want += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(want))
    row = got[70]
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (2, 1, 1)
    assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert set(joined.split(",")) <= set(row["joined"].split(","))
    assert got[3]["joined"] == "" and got[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(secrets.find_secrets(make_docs(rows)).collect()) == len(rows)
    assert secrets.find_secrets(make_docs([])).count() == 0


def test_all_rows_of_a_table_equal_brute_force(spark):
    from spanwatch.llm.scratch import documents

    texts = {r["doc_id"]: r["text"] for r in documents(spark, "/root/testdata/sf0.001").collect()}
    rows = secrets.op9_secret_scan(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = secrets.base_spans(texts[r["doc_id"]] or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize("inner", [
    encoded(encoded(SECRET)), encoded(quote(SECRET.replace("pass", "%70ass"), safe="")), encoded(encoded(encoded(SECRET))),
    encoded("".join("\\u%04x" % ord(c) for c in SECRET)), encoded(zlib.compress(encoded(SECRET).encode())),
])
def test_repeated_codes_are_unwrapped_at_each_place(inner):
    text = f"a {inner} b {inner}\nc {inner}"
    places = {(m.start(), 0, m.end()) for m in re.finditer(re.escape(inner), text)}
    assert len(places) == 3 and places <= secrets.all_spans(text).spans


def test_repeats_within_a_code_are_entered_once():
    inner = SECRET
    for _ in range(30):  # entered for each, these would be 2 ** 30 layers
        inner = encoded(zlib.compress(f"{inner} {inner}".encode(), 9))
        if len(inner) > 1 << 16:
            break
    text = f"a {inner} b"
    begin = time.time()
    assert secrets.all_spans(text).spans == {(2, 0, 2 + len(inner))}
    assert time.time() - begin < 20


@pytest.mark.parametrize("before", ["/cb/", "id_", "key-", "https://a.example.org/x/y_z/", "a-b_c/", "xyz", "ab"])
@pytest.mark.parametrize("after", ["", "==", " end", "/x"])
def test_codes_after_paths_and_names(before, after):
    code = encoded(f"some words and {SECRET} and more words.").rstrip("=")
    text = f"see {before}{code}{after}"
    found = secrets.all_spans(text).spans
    assert found and all(0 <= s < e <= len(text) and s <= 4 + len(before) and e >= 4 + len(before) + len(code) for s, _, e in found)


def test_a_code_of_either_alphabet_begins_after_a_separator():
    draw = random.Random(8)
    for _ in range(200):
        said = "".join(draw.choice("abc?>~ÿé ") for _ in range(draw.randint(0, 30))) + SECRET
        for code in (base64.b64encode(said.encode()), base64.urlsafe_b64encode(said.encode())):
            text = f"/{draw.choice(['cb', 'p/q', 'a-b', 'id_7'])}/{code.decode()}"
            assert secrets.all_spans(text).spans, text


@pytest.mark.parametrize("data", [
    gzip.compress(b"first member") + gzip.compress(SECRET.encode()), gzip.compress(SECRET.encode()) + b"\0" * 8,
    bz2.compress(b"first") + bz2.compress(SECRET.encode()), lzma.compress(SECRET.encode()),
    zlib.compress(lzma.compress(bz2.compress(gzip.compress(SECRET.encode())))),
])
def test_all_members_of_all_streams(data):
    found = secrets.all_spans(f"x {encoded(data)} y")
    assert found.spans and found.unread == 0


def test_a_layer_that_is_cut_is_read_up_to_there(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_OUTPUT", 1000)
    for fill in ("é", "漢", "\U0001F600", "a"):
        for shift in range(4):
            said = SECRET + "a" * shift + fill * 2000
            for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
                found = secrets.all_spans(encoded(pack(said.encode())))
                assert found.spans and found.unread == 1
    whole = zlib.compress((SECRET + " and so on" * 50).encode())
    found = secrets.all_spans(encoded(whole[:-9]))
    assert found.spans and found.unread == 1


def unwrapped(text):
    """Plain unwrapping of texts that are one code as a whole: every reading of it, all the way down."""
    out, todo = set(), [text.encode()]
    while todo:
        data = todo.pop()
        if data in out or not data:
            continue
        out.add(data)
        for read in (gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress, lambda d: base64.b64decode(d, validate=True),
                     lambda d: __import__("urllib.parse").parse.unquote_to_bytes(d),
                     lambda d: re.sub(rb"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)).encode(), d)):
            try:
                todo.append(read(data))
            except Exception:
                pass
    return out


def test_random_nestings_equal_plain_unwrapping():
    draw = random.Random(12)
    wrap = [
        lambda t: encoded(t), lambda t: encoded(gzip.compress(t.encode())), lambda t: encoded(zlib.compress(t.encode())),
        lambda t: encoded(bz2.compress(t.encode())), lambda t: encoded(lzma.compress(t.encode())), lambda t: quote(t, safe=""),
        lambda t: "".join("%%%02X" % b for b in t.encode()), lambda t: "".join("\\u%04x" % ord(c) for c in t),
    ]
    for number in range(150):
        inner = draw.choice([SECRET, "no such thing in here at all", "token=abc", f"two: {SECRET} and AKIA{'B2' * 9}"])
        for _ in range(draw.randint(1, 5)):
            inner = draw.choice(wrap)(inner)
            if len(inner) > 20_000:
                break
        texts = [d.decode() for d in unwrapped(inner) if d.isascii()]
        kinds = {k for t in texts for _, k, _ in secrets.base_spans(t)}
        before = draw.choice(["a ", "é\n", "(", ""])
        found = secrets.all_spans(f"{before}{inner} z")
        assert {k for _, k, _ in found.spans} == kinds, (number, inner[:80])
        assert all(len(before) <= s < e <= len(before) + len(inner) for s, _, e in found.spans)
