"""Labelled findings for the secret scan, beside those of the corpus: what looks like a secret, and what is one.

Every kind is made by a rule from a number, so the set is the same everywhere, holds nothing that was ever in
use, and can be made as large as needed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

# Words for paths, names and sentences.
WORDS = (
    "account", "archive", "balance", "bridge", "build", "cache", "channel", "cluster", "common", "config", "context", "daily", "design",
    "document", "engine", "example", "export", "factory", "feature", "filter", "footer", "garden", "global", "handler", "header", "history",
    "image", "import", "index", "install", "interface", "internal", "journal", "kernel", "language", "library", "license", "local", "manager",
    "market", "message", "module", "monitor", "network", "number", "object", "office", "option", "package", "parser", "picture", "plugin",
    "process", "profile", "project", "public", "reader", "record", "release", "report", "resource", "sample", "schema", "screen", "search",
    "section", "service", "session", "setting", "shared", "signal", "source", "station", "storage", "stream", "string", "summary", "system",
    "table", "target", "template", "thread", "translation", "update", "upload", "value", "vendor", "version", "window", "worker",
)


def _bytes(kind: str, i: int) -> bytes:
    return b"".join(hashlib.sha512(f"{kind}/{i}/{k}".encode()).digest() for k in range(4))


class _Source:
    """Choices for one finding."""

    def __init__(self, kind: str, i: int):
        self.raw, self.at = _bytes(kind, i), 0

    def number(self, n: int) -> int:
        self.at += 2
        return int.from_bytes(self.raw[self.at % 200 : self.at % 200 + 2], "big") % n

    def word(self) -> str:
        return WORDS[self.number(len(WORDS))]

    def words(self, joint: str, least: int, most: int) -> str:
        return joint.join(self.word() for _ in range(least + self.number(most - least + 1)))

    def hex(self, n: int) -> str:
        return self.raw.hex()[60 : 60 + n]

    def text(self, n: int, alphabet: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") -> str:
        return "".join(alphabet[b % len(alphabet)] for b in self.raw[-n:])

    def base64(self, n: int) -> str:
        return base64.b64encode(self.raw[30 : 30 + n]).decode()


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_MARKS = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789!$%&*+?#@^~"


def _title(words: str) -> str:
    return "".join(w.title() for w in words.split())


# What is no secret: (text before, candidate, text after) of each kind.
HARMLESS = {
    "uuid": lambda s: (s.word() + (" id ", " uuid: ", " ref ", ' guid="')[s.number(4)], str(uuid.UUID(bytes=s.raw[:16])), " was"),
    "commit": lambda s: ("in " + ("commit ", "revision ", "tree ", "parent ")[s.number(4)], s.hex(40), " on main"),
    "digest": lambda s: (("sha256:", "md5: ", "checksum ", "sha1=", "digest ")[s.number(5)], s.hex((64, 32, 40)[s.number(3)]), "\n"),
    "bare hash": lambda s: (s.words(" ", 2, 4) + " ", s.hex((40, 32, 64)[s.number(3)]), "  " + s.word() + ".txt"),
    "integrity": lambda s: ('"integrity": "', f"sha512-{s.base64(60)}", '",'),
    "path": lambda s: ("see ", f"/{s.words('/', 3, 6)}{('', '2', '-1', '_v3')[s.number(4)]}/{s.word()}", " for"),
    "path with digits": lambda s: ("open ", f"/{s.word()}{s.number(99)}/{s.words('/', 2, 4)}{s.number(999)}", "\n"),
    "relative path": lambda s: ("from ", f"{s.words('/', 3, 5)}/{s.words('_', 2, 3)}", ".py"),
    "address": lambda s: (f"https://{s.word()}.example.org/", f"{s.words('/', 2, 4)}-{s.number(10**4)}/{s.words('-', 2, 4)}", " is"),
    "kebab name": lambda s: ("the ", f"{s.words('-', 3, 5)}{('', '2', '-3', '-v1')[s.number(4)]}", " page"),
    "snake name": lambda s: ("call ", f"{s.words('_', 3, 5)}{('', '_2', '1')[s.number(3)]}", "()"),
    "upper name": lambda s: ("set ", f"{s.words('_', 3, 4).upper()}{('', '_2', '_V1')[s.number(3)]}", " to"),
    "camel name": lambda s: ("class ", f"{_title(s.words(' ', 3, 4))}{('', '2', 'V3')[s.number(3)]}", "("),
    "long word": lambda s: ("of ", f"{s.word()}{s.word()}{s.word()}-and-{s.word()}{s.word()}{s.number(9)}", ", which"),
    "version": lambda s: ("release ", f"{s.word()}-{s.number(9)}_{s.number(20)}_{s.number(30)}-linux-x86_64", " is"),
    "timestamp": lambda s: ("at ", f"2024{1 + s.number(12):02d}{1 + s.number(28):02d}T{s.number(24):02d}{s.number(60):02d}00Z-{s.number(999):03d}", " the"),
    "number": lambda s: ("order ", str(int(s.hex(15), 16) + 10**15), " was"),
    "image": lambda s: ("data:image/png;base64,", s.base64(90), '"'),
    "font": lambda s: ("url(data:font/woff2;base64,", s.base64(120), ")"),
    "placeholder": lambda s: (("password = ", "api_key: ", "token=")[s.number(3)], ("<your-{}-here>", "${{{}_VALUE}}", "xxxxxxxxxxxxxxxx", "***{}***")[s.number(4)].format(s.word()), "\n"),
    "rule line": lambda s: ("\n", "=-"[s.number(2)] * (16 + s.number(50)) + "0" * s.number(2), "\n"),
}

# What is one.
SECRET = {
    "cloud key": lambda s: (s.word() + " ", ("AKIA", "ASIA")[s.number(2)] + s.text(16, _UPPER), " and"),
    "forge token": lambda s: ("use ", f"gh{'pousr'[s.number(5)]}_{s.text(36)}", " to"),
    "service key": lambda s: ("with ", ("sk-", "sk_live_", "rk_test_")[s.number(3)] + s.text(28 + s.number(8)), "\n"),
    "chat token": lambda s: ("bot ", f"xox{'bp'[s.number(2)]}-{s.number(10**4)}{s.number(10**4)}-{s.text(24)}", " in"),
    "web token": lambda s: ("sent ", f"eyJ{s.text(24)}.eyJ{s.text(40)}.{s.text(43)}", " on"),
    "named hex": lambda s: (('token = "', "secret: ", "api_key=", 'auth_token: "')[s.number(4)], s.hex((32, 40, 64)[s.number(3)]), '"'),
    "named text": lambda s: (("token=", 'secret = "', "access_key: ", "apikey=")[s.number(4)], s.text(20 + s.number(24)), "\n"),
    "named base64": lambda s: (("private_key: ", 'client_secret = "', "credential=")[s.number(3)], s.base64(30), "\n"),
    "password": lambda s: (("password = '", "pwd: ", 'passwd="', "password: ")[s.number(4)], s.text(9 + s.number(9), _MARKS), "'"),
    "word password": lambda s: (("password='", 'pwd="', "passwd: ")[s.number(3)], f"{s.word()}{s.number(9999)}{'!$%*'[s.number(4)]}{s.word()}", "'"),
    "letters password": lambda s: (("password='", 'secret="', "pwd='")[s.number(3)], s.text(10 + s.number(8), "abcdefghijklmnopqrstuvwxyz"), "'"),
    "digits password": lambda s: (("pwd=", "passwd=", "password: ")[s.number(3)], s.text(8 + s.number(5), "0123456789"), "\n"),
    "bearer": lambda s: ("Authorization: Bearer ", s.text(32 + s.number(20)), "\n"),
    "login in address": lambda s: (f"{('postgres', 'mysql', 'amqp', 'https')[s.number(4)]}://{s.word()}:", s.text(8 + s.number(10)), f"@{s.word()}.example.org/{s.word()}"),
    "word login": lambda s: (f"{('postgres', 'redis', 'mongodb+srv')[s.number(3)]}://{s.word()}:", f"{s.word()}{s.number(99)}{s.word()}", "@db.example.org:5432/"),
    "key block": lambda s: ("\n", f"-----BEGIN {('RSA ', '', 'EC ')[s.number(3)]}PRIVATE KEY-----\n{s.base64(90)}\n-----END PRIVATE KEY-----", "\n"),
}


def stated_findings(each: int = 40, start: int = 0, without: tuple[str, ...] = ()) -> list[tuple[str, str, str, int, str]]:
    """(before, candidate, after, label, kind): ``each`` findings of every kind but those ``without``."""
    out = []
    for label, kinds in ((0, HARMLESS), (1, SECRET)):
        for kind, make in kinds.items():
            if kind not in without:
                out += [(*make(_Source(kind, start + i)), label, kind) for i in range(each)]
    return out
