"""Texts made to be slow, endless or large, and secrets in unusual places."""

import base64
import gzip
import random
import time
import tracemalloc
import zlib

import pytest

from pathwake.llm import private_data, secret_scan

SECRET = "password=hunter2hunter2"


def seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def decoded(text):
    return [(k, text[a:b]) for a, b, k in secret_scan.scan_text(text)[1]]


@pytest.mark.parametrize("before", ["", "https://ho/", "https://hos/", "https://h/", "Basic_", "token/", "x", "xy", "xyz", "a/b-c_", "abc-"])
@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress])
def test_glued_base64(before, pack):
    code = base64.b64encode(pack(SECRET.encode())).decode()
    text = f"see {before}{code} end"
    assert any(k == "decoded_assign" for k, _ in decoded(text))


def test_a_stream_that_holds_itself_ends(monkeypatch):
    own = gzip.compress(b"some content")
    real = secret_scan._inflate
    monkeypatch.setattr(secret_scan, "_inflate", lambda data, room: data if data == own else real(data, room))
    assert secret_scan.scan_text("x " + base64.b64encode(own).decode())[1] == []


def test_streams_in_streams():
    data = SECRET.encode()
    for i in range(6):
        data = (gzip.compress if i % 2 else zlib.compress)(data)
    assert decoded("see " + base64.b64encode(data).decode() + " end")


@pytest.mark.parametrize("escape, last", [("%25", "%3D"), ("\\x5c", "\\x3d"), ("\\u005c", "\\u003d")])
def test_nested_escapes_take_linear_time(escape, last):
    body = escape[0] + (escape[1:]) * 300_000 + last[1:]
    text = f"password{body}hunter2hunter2 " + "word " * 1000
    assert seconds(lambda: secret_scan.scan_text(text)) < 25
    assert ("decoded_assign", f"password{body}hunter2hunter2") in decoded(text)


def test_every_depth_of_escapes_is_found():
    for depth in range(1, 12):
        text = "a password" + "%" + "25" * (depth - 1) + "3D" + "hunter2hunter2 b"
        assert decoded(text) == [("decoded_assign", text[2:-2])], depth
    mixed = "password\\u0025%35%43\\x33\\x44hunter2hunter2"
    assert secret_scan.scan_text(mixed)[0] == []
    # Peeling agrees with going level by level.
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(["%", "25", "41", "\\x", "\\u00", "&#3", "7;", "a", " "]) for _ in range(30))
        layer = secret_scan.Layer(text, level=secret_scan.LEVELS)
        peeled = next(secret_scan._peeled_layers(layer), None)
        assert peeled is None or len(peeled.text) == len(peeled.begins) == len(peeled.ends) and (peeled.begins < peeled.ends).all()


def test_false_streams_take_linear_time():
    assert seconds(lambda: secret_scan.scan_text("-eJz" * 250_000)) < 20
    assert seconds(lambda: secret_scan.scan_text("A" * 1_000_000)) < 20


def test_large_streams_are_held_one_at_a_time():
    streams = " ".join(base64.b64encode(gzip.compress(bytes([65 + i]) * 10_000_000 + b" " + SECRET.encode())).decode() for i in range(4))
    tracemalloc.start()
    found = secret_scan.scan_text(streams)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[1]) == 4 and found[2] == 0 and peak < 100_000_000


@pytest.mark.parametrize("cue", ["iban", "Account", "SSN", "passport", "acct number", "://"])
def test_blanks_after_cues_take_linear_time(cue):
    assert seconds(lambda: private_data.find(cue + " " * 5_000_000)) < 1
    assert seconds(lambda: private_data.find((cue + " :" + " " * 1000) * 1000)) < 1


def test_cues_in_any_case_and_logins():
    text = "aCCoUNT  no. :#= 12345678, Iban: GB82 WEST 1234 5698 7654 32 and ftp://joe:p@ss:w@rd@host.org/x http://h:80/a@b.org"
    found = {k: [text[a:b] for a, b in v] for k, v in private_data.find(text).items()}
    assert found["account"] == ["12345678"] and found["iban"] == ["GB82 WEST 1234 5698 7654 32"]
    assert found["login"] == ["joe:p@ss:w@rd"]
