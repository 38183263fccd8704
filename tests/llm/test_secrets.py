from __future__ import annotations

import base64
import hashlib
import json
import re
import time

from saldora.llm import secrets
from saldora.llm.queries import op1_secret_scan

from tests_llm_helpers import by_id, documents, rows


def _b64(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def _der(tag: int, body: bytes) -> bytes:
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


TOKEN = ".".join([_b64(json.dumps({"alg": "HS256"}).encode()), _b64(b'{"sub":"1"}'), _b64(b"x" * 32)])
KEY = _der(0x30, _der(2, b"\0") + _der(2, b"\x01" * 200) + _der(2, b"\x01\0\x01"))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", b"k" * 32))


def test_structures():
    assert secrets.is_signed_token(TOKEN)
    assert not secrets.is_signed_token(TOKEN.rsplit(".", 1)[0] + ".")  # algorithm without signature
    assert not secrets.is_signed_token("aaaaaaaa.bbbbbbbb.cccccccc")
    assert secrets.is_der_key(KEY)
    assert not secrets.is_der_key(KEY[:-1])  # the outer length does not fit
    assert not secrets.is_der_key(_der(0x30, _der(2, b"\0") + b"\x02\x7f\x01"))  # nor an inner one
    assert secrets.is_ssh_key(SSH) and not secrets.is_ssh_key(SSH[:-1])


def test_confirmed_spans_join_base_spans(spark):
    body = base64.b64encode(KEY).decode()
    wrapped = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
    text = f"é token={TOKEN} then\n{wrapped}\nand {SSH.hex()} or {'ab' * 40}"
    found = by_id(secrets.scan_secrets(documents(spark, [(1, text), (2, None), (3, ""), (3, "")])).limit(2))[1]
    kinds = re.findall(r"(\w+):(\d+):(\d+)", found["spans"])
    assert [k for k, *_ in kinds] == ["assign", "token", "key", "hex", "key", "hex"]
    for kind, start, end in kinds:
        piece = text[int(start) : int(end)]
        assert {"token": TOKEN, "key": None}.get(kind, None) in (None, piece)
    assert (found["n_assign"], found["n_hex"], found["n_token"], found["n_key"]) == (1, 2, 1, 2)


def _brute(text: str):
    """Base spans by trying every position in turn."""
    out = []
    for kind, pattern, least, group in (
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
        ("access", r"AKIA[A-Z0-9]+", 16, 0),
        ("hex", r"[0-9a-f]+", 32, 0),
    ):
        at, compiled = 0, re.compile(pattern)
        while at < len(text):
            m = compiled.match(text, at)
            if m is None:
                at += 1
                continue
            if len(m[group]) >= least:
                out.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
            at = m.end()
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out))


def test_base_spans_against_positions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in rows(docs.select("doc_id", "text"))}
    found = by_id(op1_secret_scan(spark, sf_dir))
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        base = _brute(texts[doc_id] or "")
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        own = [s for s in row["spans"].split(",") if s.split(":")[0] in secrets.BASE]
        assert ",".join(own) == base


def test_dropped_match_uses_up_its_characters():
    # the first match takes "password=abc" and fails; what it covered starts no other
    assert secrets.base_spans("secret:token token=abcdefgh") == [(13, 27, "assign")]
    assert secrets.base_spans("toKen=abcdefgh")[0][2] == "assign"
    assert secrets.base_spans("toKen=abcdefgh") == []  # a Kelvin sign is no letter k


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark, [(1, "a password=12345678 b " + "0" * 32), (2, None), (None, ""), (4, "x" * 200_000)])
    out = rows(secrets.redact_secrets(docs))
    assert out[0]["text"] == "a [secret] b [secret]" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[1]["text"] is None and out[2]["text"] == "" and len(out[3]["text"]) == 200_000
    assert list(out[0]) == docs.columns
    assert rows(secrets.scan_secrets(documents(spark, []))) == []


def _pem(data: bytes, width: int = 64, join: str = "\n") -> str:
    body = base64.b64encode(data).decode()
    return join.join(body[i : i + width] for i in range(0, len(body), width))


def _public(bits_bytes: int) -> bytes:
    inner = _der(0x30, _der(2, b"\0" + b"\x99" * bits_bytes) + _der(2, b"\x01\0\x01"))
    algorithm = _der(0x30, _der(6, bytes.fromhex("2a864886f70d010101")) + _der(5, b""))
    return _der(0x30, algorithm + _der(3, b"\0" + inner))


def _of_size(size: int) -> bytes:
    """A private-key sequence of exactly ``size`` bytes."""
    return _der(0x30, _der(2, b"\0") + _der(4, b"\x05" * (size - 11)))


def _keys(text: str) -> list[str]:
    return [text[a:b] for a, b, kind in secrets.confirmed_spans(text) if kind == "key"]


def test_wrapped_keys_with_a_last_line_of_any_length():
    assert len(_public(256)) == 294
    for key in (_public(256), *(_of_size(n) for n in (64, 1216, 1217, *range(1190, 1240)))):
        for join in ("\n", "\r\n", "\n    ", "  \r\n\t", " "):
            for width in (64, 76, 61):
                body = _pem(key, width, join)
                for text in (
                    f"-----BEGIN KEY-----\n{body}\n-----END KEY-----\n", f"see {body}", f"{body} and more words",
                    f"{'w' * 30}\n{body}\n{'v' * 40} x",
                ):
                    assert _keys(text) == [body], (len(key), join, width)


def test_keys_on_adjacent_lines_are_told_apart():
    one = [base64.b64encode(k).decode().rstrip("=") for k in (_of_size(66), _of_size(81), SSH, SSH)]
    assert _keys("\n".join(one)) == one
    assert _keys("\r\n".join([one[2], one[0], "w" * 31, one[3], one[1]])) == [one[2], one[0], one[3], one[1]]
    two = [_pem(_public(256)), _pem(_of_size(1200))]
    assert _keys("\n".join(two)) == two


def test_private_ssh_key_with_its_last_line():
    def field(x: bytes) -> bytes:
        return len(x).to_bytes(4, "big") + x

    for size, tag in ((136, b""), (141, b""), (144, b"t" * 16)):
        key = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + b"\0\0\0\1" + field(SSH)
        body = _pem(key + field(b"p" * size) + tag, 70)
        assert _keys(f"-----BEGIN OPENSSH PRIVATE KEY-----\n{body}\n-----END OPENSSH PRIVATE KEY-----") == [body]


def test_keys_written_into_other_texts():
    """Escaped line ends, quoted and joined lines, quoted mail, lists, comments: the key is whole."""
    for size in (150, 294, 609, 1217):
        key = _of_size(size)
        lines = _pem(key).split("\n")
        for text in (
            '{"pem": "-----BEGIN KEY-----\\n' + "\\n".join(lines) + '\\n-----END KEY-----\\n"}',
            "\n".join(f'    "{x}" +' for x in lines[:-1]) + f'\n    "{lines[-1]}";',
            "[" + ",\n ".join(f"'{x}'" for x in lines) + "]",
            "\n".join(f"> {x}" for x in lines) + "\n> regards",
            "\n".join(f"> > {x}" for x in lines),
            "\n".join(f"# {x}" for x in lines),
            "\\r\\n".join(lines),
            "\n".join(f" * {x}" for x in lines),
            "| " + " |\n| ".join(lines) + " |",
        ):
            found = [s for s in secrets.confirmed_spans(text) if s[2] == "key"]
            assert len(found) == 1, (size, text[:90])
            span = text[found[0][0] : found[0][1]]
            assert span.startswith(lines[0]) and span.rstrip("=").endswith(lines[-1].rstrip("="))


def test_keys_behind_other_characters():
    body = base64.b64encode(KEY).decode()
    ssh = base64.b64encode(SSH).decode()
    for before in ("/", "x-", "key_", "abc/def+", "A" * 40):
        for text in (body, ssh):
            found = [s for s in secrets.confirmed_spans(f"see {before}{text} end") if s[2] == "key"]
            assert [f"see {before}{text} end"[a:b] for a, b, _ in found] == [text]
    for hexed in (KEY.hex(), KEY.hex().upper(), SSH.hex()):
        for text in (f"0x{hexed}", f"key: 0X{hexed};", hexed):
            assert [text[a:b] for a, b, k in secrets.confirmed_spans(text) if k == "key"] == [hexed]


def test_long_texts_of_joints_and_firsts():
    """Linear in texts that begin keys everywhere and end none."""
    start = time.perf_counter()
    for text in ("MIIB" * 60_000, "AAAAB3NzaC1" * 20_000, ("A" * 30 + '" + "') * 8_000, "MIIB" * 8 + "\\n" * 60_000):
        secrets.find_spans(text)
    assert time.perf_counter() - start < 20
