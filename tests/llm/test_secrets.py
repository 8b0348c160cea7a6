import random
import re

from millrace.llm import secrets

from .odd import clashing, empty_docs, odd_docs, real


def either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def slow_base(text):
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + f"|{either('api')}_?{either('key')}"
    out = []
    for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(out)]


def base(text):
    return [(s["kind"], s["start"], s["stop"]) for s in secrets.spans_of((text or "").encode()) if s["kind"] in secrets.KINDS[:3]]


def test_base_kinds_against_plain_patterns(spark):
    random.seed(2)
    parts = ["password", "PassWd", "api_key", "ApiKey", "toKEN", "ſecret", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH01234567", "0123456789abcdef", "é", "😀", "-", "\n", "secret=", "x"]
    texts = ["".join(random.choices(parts, k=random.randrange(14))) for _ in range(6000)]
    texts += [r.text for r in real(spark, "documents", "0.01").collect()]
    for text in texts:
        assert base(text) == slow_base(text), repr(text)


def kinds(text):
    return [s["kind"] for s in secrets.spans_of(text.encode())]


def test_weak_parts_need_company():
    key, random_part = "AKIA" + "Q" * 16, "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0dF3gH6jK9m"
    assert kinds(random_part) == []
    assert kinds("client_id: web-77") == []
    assert kinds("https://db.example.com/x") == []
    assert kinds(f"{key} {random_part} https://s3.example.com") == ["access", "secret", "endpoint"]
    assert kinds(f"client_id: web-77 {random_part}") == ["identifier", "secret"]
    assert kinds(f"{key}\n\n{random_part}") == ["access"]
    assert kinds(f"{key} {'word ' * 80}{random_part}") == ["access"]
    assert kinds(f"{key} see https://s3.example.com") == ["access"]


def slow_links(text):
    """All spans, by comparing every part with every other, in code points."""
    lower = "".join(c.lower() if c.isascii() else c for c in text)

    def found(pattern, where):
        return [m.span() for m in re.finditer(pattern.pattern.decode(), where, re.ASCII)]

    def free_of(span, others):
        return all(span[1] <= a or b <= span[0] for a, b in others)

    def linked(span, others):
        for other in others:
            (_, stop), (start, _) = sorted((span, other))
            if start <= stop or (start - stop <= secrets.SCOPE and "\n\n" not in text[stop:start]):
                return True
        return False

    spans = slow_base(text)
    base = [s[1:] for s in spans]
    strong = [s[1:] for s in spans if s[0] in ("assign", "hex")]
    access = [s[1:] for s in spans if s[0] == "access"]
    names = [s for s in found(secrets.IDENTIFIER, lower) if free_of(s, base)]
    random_parts = [s for s in found(secrets.SECRET, text) if free_of(s, base) and all(re.search(p, text[slice(*s)]) for p in ("[a-z]", "[A-Z]", "[0-9]"))]
    random_parts = [s for s in random_parts if linked(s, access + names)]
    names = [s for s in names if linked(s, strong + random_parts)]
    places = [s for s in found(secrets.ENDPOINT, lower) if free_of(s, base + names + random_parts) and linked(s, access + names) and linked(s, strong + random_parts)]
    spans += [("identifier", *s) for s in names] + [("secret", *s) for s in random_parts if free_of(s, names)] + [("endpoint", *s) for s in places]
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


def all_spans(text):
    return [(s["kind"], s["start"], s["stop"]) for s in secrets.spans_of(text.encode())]


def planted(many, seed):
    """Texts in which parts of credentials stand close together, too far apart, or behind a blank line."""
    random.seed(seed)
    parts = ["AKIA" + "Q" * 16, "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0dF3gH6jK9m", "client_id: web-77", "user_id = bob", "password: hunter22", "0123456789abcdef" * 2, "https://s3.example.com/bucket", "host: db.example.org:5432",
             "token=" + "0123456789abcdef" * 2 + "." + "x" * 120]
    fills = [" ", ", ", "\n", "\n\n", "é" * 200, "a " * 100, "é " * 149, "é " * 150, "é " * 151, "x " * 149 + " ", "x " * 150 + " ", "word " * 80, "😀 " * 120]
    return ["".join(x for _ in range(random.randrange(1, 8)) for x in (random.choice(parts), " " + random.choice(fills) + " ")) for _ in range(many)]


def test_links_against_brute_force():
    texts = planted(4000, 5)
    seen = set()
    for text in texts:
        want = slow_links(text)
        assert all_spans(text) == want, repr(text)
        seen |= {s[0] for s in want}
    assert seen == set(secrets.KINDS)


def test_links_that_a_nearer_part_hides_and_that_count_code_points():
    inner = "0123456789abcdef01234567"
    assert kinds(f"token={inner}.{'x' * 320} client_id: web-77") == ["assign", "hex", "identifier"]
    for fill in "zé":
        assert kinds(f"AKIA{'Q' * 16} {fill * 200} aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0dF3gH6") == ["access", "secret"]


def test_planted_table(spark):
    texts = planted(300, 6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(docs).collect():
        assert [tuple(s) for s in r.secret_spans] == slow_links(texts[r.doc_id])
    for r in secrets.redacted(docs).collect():
        assert len(r.text) < len(texts[r.doc_id]) or not slow_links(texts[r.doc_id])


def test_base_spans_stay_when_weak_ones_join():
    text = f"user_id = bob password: hunter22 aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0dF3gH6"
    found = secrets.spans_of(text.encode())
    assert [s["kind"] for s in found] == ["identifier", "assign", "secret"]
    assert base(text) == slow_base(text)


def test_odd_rows(spark):
    found = secrets.find_secrets(clashing(odd_docs(spark)))
    assert sum(len(r.secret_spans) for r in found.collect()) == 0
    assert secrets.find_secrets(empty_docs(spark)).count() == 0


def test_redaction_leaves_clean_texts(spark):
    docs = real(spark, "documents", "0.01").union(odd_docs(spark))
    before, after = docs.collect(), secrets.redacted(docs).collect()
    assert len(before) == len(after)
    old = sorted((str(r.doc_id), str(r.text)) for r in before if not slow_base(r.text))
    new = {(str(r.doc_id), str(r.text)) for r in after}
    assert all(x in new for x in old)
    assert all(not slow_base(r.text) for r in after)
    assert any("[SECRET]" in (r.text or "") for r in after)
