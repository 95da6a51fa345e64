import hashlib

from awkward import AWKWARD

from stridelake.llm import secret_scan


def documents(n, start=0):
    """Secrets beside what only looks like them; the wording differs from document to document."""
    rows, truth = [], {}
    words = ["river", "stone", "window", "letter", "garden", "paper", "yellow", "winter", "music", "little"]
    for i in range(start, start + n):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        filler = " ".join(words[int(c, 16) % 10] for c in h)
        kind = i % 4
        if kind == 0:
            text = f'{filler} token = "{h}" {filler[:50]}'
            truth[i] = h
        elif kind == 1:
            text = f"{filler} see https://example.org/{words[i % 10]}/{words[i % 7]}-{i}0000000/index {filler[:30]}"
        elif kind == 2:
            text = f"{filler} order {int(h, 16) % 10**16:016d} was paid {filler[:40]}"
        else:
            text = f"{filler} commit {h} in windowGardenPaper2024 {filler[:40]}"
        rows.append((i, text))
    return rows, truth


def test_held_out_findings(spark, docs_of):
    learn, _ = documents(800)
    scanner = secret_scan.fitted(docs_of(learn, clashing=False))
    rows, truth = documents(400, start=10_000)
    docs = docs_of(rows + AWKWARD)
    out = secret_scan.with_secrets(docs, scanner)
    assert sorted(out.columns) == sorted(docs.columns)
    found = {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["scan"]["secrets"]] for r in out.where("doc_id >= 10000").collect()}
    caught = sum(found[i] == [h] for i, h in truth.items())
    wrong = sum(len(s) for i, s in found.items() if i not in truth)
    assert caught >= 0.95 * len(truth) and wrong <= 0.05 * len(rows)
    clean = secret_scan.redacted(docs, scanner)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in clean.where("doc_id >= 7").collect()}
    for i, h in truth.items():
        if found[i] == [h]:
            assert h not in text[i] and secret_scan.MASK in text[i]
    assert text[7] is None and text[8] == ""


def test_given_labels_and_nothing_to_learn(spark, docs_of):
    docs = docs_of(documents(40)[0], clashing=False)
    found = secret_scan.findings(docs)
    marked = found.selectExpr("before", "candidate", "after", "CAST(candidate LIKE 'window%' AS INT) AS label")
    scanner = secret_scan.fitted(docs, marked)
    named = [x for s, (_, t) in zip(scanner.scan([t for _, t in documents(40)[0]]), documents(40)[0]) for x in [t[a:b] for a, b, p in s if p >= 0.5]]
    assert named and all(x.startswith("window") for x in named)
    empty = secret_scan.fitted(docs.limit(0))
    assert [x for x in empty.scan(["token = 'abcdefgh12345678'", None, ""])] == [[(9, 25, 0.0)], [], []]
    assert secret_scan.with_secrets(docs.limit(0), empty).count() == 0


def test_candidates():
    text = 'password: "hunter2-long" -----BEGIN RSA PRIVATE KEY-----\nAB\n-----END RSA PRIVATE KEY----- aVeryLongMixedCaseWord internationalisation 1234567890123456'
    assert [text[a:b][:12] for a, b in secret_scan.candidates(text)] == ["hunter2-long", "-----BEGIN R", "aVeryLongMix", "123456789012"]


def shapes(i):
    """One secret of each shape, and the text around it."""
    h = hashlib.sha512(str(i).encode()).hexdigest()
    letters = "".join(chr(97 + int(h[k : k + 2], 16) % 26) for k in range(0, 64, 2))
    mixed = "".join(c.upper() if int(h[k], 16) % 2 else c for k, c in enumerate(letters)) + h[:8]
    jwt = f"eyJ{mixed[:20]}.eyJ{mixed[4:30]}.{mixed[2:38]}"
    return [
        (f"{h[:3]}!S3t@{letters[:4]}", 'password = "{}"'), (letters[:10] + h[0] + "7", "pwd: {}"), (letters[:14], 'secret="{}"'),
        (str(int(h[:16], 16))[:12], "passwd={}"), (jwt, 'access_key: "{}"'), (jwt, "sent {} on"),
        ("AKIA" + (letters[:12] + "27AZ").upper(), "with {} here"), ("AKIA" + letters[:16].upper(), "with {} here"),
        ("ghp_" + mixed[:36], "using {} there"), ("sk-" + mixed[:32], "and {} too"),
    ]


def test_secrets_of_many_shapes(spark, docs_of):
    def planted(n, start):
        rows, truth = documents(n, start)
        for i, (_, text) in enumerate(rows):
            if i % 4 != 0 and i % 3 == 0:
                secret, around = shapes(start + i)[i // 3 % 10]
                rows[i] = (start + i, f"{text[:60]} {around.format(secret)} {text[60:]}")
                truth[start + i] = secret
        return rows, truth

    scanner = secret_scan.fitted(docs_of(planted(1200, 0)[0], clashing=False))
    rows, truth = planted(1200, 50_000)
    missed, wrong = [], []
    for (i, text), found in zip(rows, scanner.scan([t for _, t in rows])):
        named = [text[a:b] for a, b, p in found if p >= secret_scan.THRESHOLD]
        missed += [truth[i]] if i in truth and truth[i] not in named else []
        wrong += [x for x in named if x != truth.get(i)]
    assert len(missed) <= 0.05 * len(truth) and len(wrong) <= 0.05 * len(rows), (len(missed), len(truth), missed[:9], wrong[:9])


def test_rule_leaves_doubt_open():
    words = {"window", "garden", "paper"}
    for secret, around in shapes(5):
        before, after = around.split("{}")
        assert secret_scan.rule(before, secret, after) == 1, (secret, around)
    clear = [("see https://example.", "org/river/letter-10000000/index"), ("order ", "1234567890123456"), ("commit ", "ab" * 20),
             ("in ", "windowGardenPaper2024"), ("token: ", "https://example.org/a-page"), ("password=", "<your-password>"),
             ("password: ", "********"), ("in ", "/usr/local/share/data-2024")]
    assert [secret_scan.rule(b, c, " ", words) for b, c in clear] == [0] * len(clear)
    open_ = [("id ", "ab" * 20), ("see ", "x9Qz7Lm2Vt5Rk8Pw"), ("the password: ", "something"), ("token = ", "os.environ['A_TOKEN']")]
    assert [secret_scan.rule(b, c, " ", words) for b, c in open_] == [None] * 4


def test_dictionary_is_the_same_rule_at_every_size(spark, docs_of):
    """Words of nearly equal frequency all stay, long ones too; below the share a word is left out, whatever the size."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = ["".join(letters[i // 26**k % 26] for k in range(4)) + "internationally" * (i % 2) for i in range(25_000)]
    rows = [(i, " ".join(many)) for i in range(2)]
    about = secret_scan.corpus(docs_of(rows, clashing=False))
    assert about.words == set(many)
    assert about.covered("x1" + many[1] + "9") == len(many[1])
    for times in (10, 40):
        rows = [(i, "river stone " * 50 + "uncommon," * (i % 5 == 0)) for i in range(times)]
        assert secret_scan.corpus(docs_of(rows, clashing=False), share=0.005).words == {"river", "stone"}
        assert secret_scan.corpus(docs_of(rows, clashing=False), share=0.001).words == {"river", "stone", "uncommon"}


def test_coverage_of_the_whole_candidate():
    about = secret_scan.Corpus({"window"}, secret_scan.np.zeros(secret_scan._CLASSES**2))
    at = secret_scan.FEATURES.index("covered")
    assert secret_scan.features(about, "", "window" * 50 + "0" * 300, "")[at] == 0.5
    assert secret_scan.features(about, "", "0" * 300 + "window" * 50, "")[at] == 0.5
