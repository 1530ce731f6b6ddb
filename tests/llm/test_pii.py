import hashlib
import random
import re
from collections import defaultdict

from llm_helpers import docs, sentence
from ratelake.llm import pii
from ratelake.llm.pii import KINDS, personal_data

# the patterns as given, for the brute force
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in GIVEN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def run(spark, rows, **options):
    return personal_data(docs(spark, rows), **options).collect()


TEXTS = [
    None, "", "nothing here", "a@b.c_d@e.f,x@y@z.de and q@w", "mail é😀 jo.do+x@mail-1.example.com. end",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0300.1.1.1 99999999999999999999.1.1.1 12.34.56", "10.0.0.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 0000000000000000000 12345678901234567890",
    "+1 (705) 555-6638 + 1 234 +12 34 +49.30.1234567-8 +123456789012345678 +1--------",
    "+1 4111 1111 1111 1111", "a" * 40_000 + "@b.co", "a." * 20_000 + "x", "7" * 30_000, "1." * 20_000, "+1" + " 2" * 9000,
    "😀" * 50 + "12.34.56.78" + "é" * 5 + "x@y.zz",
]


def test_base_spans_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(4, TEXTS[4]), (None, TEXTS[4])]
    got = run(spark, rows)
    assert len(got) == len(rows)
    want = {hashlib.sha256(",".join(brute(t)).encode()).hexdigest() for t in TEXTS}
    assert {r.base_sha256 for r in got} == want
    for r in got:
        spans = brute(TEXTS[4 if r.doc_id is None else r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), r.doc_id
        for kind in KINDS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in spans)
        assert set(spans) <= set(r.spans.split(",")) or not spans


def test_bootstrap_finds_unknown_identifiers_in_known_contexts(spark):
    rows = [(i, f"{sentence(i, 8)} please call me {'+1 (%03d) 555-%04d' % (200 + i, 1000 + i)} now {sentence(100 + i, 5)}") for i in range(12)]
    rows += [(50, f"{sentence(50, 6)} please call me 0705/555-6638 now or never")]  # no fixed pattern has it
    rows += [(60, f"{sentence(60, 6)} order number 070555 arrived"), (61, "in 20241 weeks")]
    got = {r.doc_id: r for r in run(spark, rows)}
    text = dict(rows)[50]
    at = text.index("0705/")
    assert got[50].n_phone == 0 and got[50].spans == f"phone:{at}:{at + 13}"
    assert got[60].spans == got[61].spans == ""
    assert all(got[i].n_phone == 1 and got[i].spans.count(":") == 2 for i in range(12))


def test_bootstrap_takes_the_form_of_the_kind(spark):
    """Unknown e-mail and ip forms have few digits or none; a number of digits is asked of phones only."""
    rows = [(i, f"{sentence(i, 8)} mail me at u{chr(97 + i)}@site{chr(97 + i)}.org today {sentence(100 + i, 5)}") for i in range(12)]
    rows += [(20 + i, f"{sentence(20 + i, 8)} the host is 10.1.2.{i} inside {sentence(120 + i, 5)}") for i in range(12)]
    rows += [(50, f"{sentence(50, 6)} mail me at jane.doe@localhost or never"), (51, f"{sentence(51, 6)} the host is fe80::1 or so")]
    rows += [(52, f"{sentence(52, 6)} the host is 10.0.0.x here"), (53, f"{sentence(53, 6)} mail me at 10 or later")]
    rows += [(54, f"{sentence(54, 6)} the host is 7 or so"), (55, f"{sentence(55, 6)} written by jane.doe@localhost alone")]
    got, text = {r.doc_id: r.spans for r in run(spark, rows)}, dict(rows)
    for i, kind, m in ((50, "email", "jane.doe@localhost"), (51, "ip", "fe80::1"), (52, "ip", "10.0.0.x")):
        at = text[i].index(m)
        assert got[i] == f"{kind}:{at}:{at + len(m)}"
    assert got[53] == got[54] == got[55] == ""


def test_bootstrap_finds_unknown_identifiers_beside_known_ones(spark):
    """An identifier one space or mark away from a base span is a candidate of its own."""
    rows = [(i, f"{sentence(i, 8)} please call me {'+1 (%03d) 555-%04d' % (200 + i, 1000 + i)} now {sentence(100 + i, 5)}") for i in range(12)]
    rows += [(20 + i, f"{sentence(20 + i, 8)} entry u{chr(97 + i)}@x.org {'+1 (%03d) 555-%04d' % (300 + i, 2000 + i)} {sentence(120 + i, 5)}") for i in range(12)]
    beside = {
        50: "😀 please call me 0705/555-6638 jane@x.org now",
        51: "please call me 0705/555-6638 (mail:jane@x.org), now",
        52: "😀 entry jane@x.org 0705/555-6638 then",
        53: "please call me 0705/555-6638 +1 (705) 555-6638 now",
        54: "entry jane@x.org, 0705/555-6638 jo@x.org 99 later",
    }
    got = {r.doc_id: r.spans.split(",") for r in run(spark, rows + list(beside.items()))}
    for i, text in beside.items():
        at = text.index("0705/")
        assert sorted(got[i]) == sorted(brute(text) + [f"phone:{at}:{at + 13}"]), i
    for i, text in rows:
        assert got[i] == brute(text)


def test_copies_are_scanned_once(spark, monkeypatch):
    scanned, matches = [], pii.matches
    monkeypatch.setattr(pii, "matches", lambda docs, *more: (scanned.append(docs.count()), matches(docs, *more))[1])
    got = run(spark, [(i, "call a@b.cd or 10.0.0.1") for i in range(30)] + [(40, "x@y.zz"), (41, None)])
    assert scanned == [2] * 5 and len(got) == 32
    assert all(r.spans == "email:5:11,ip:15:23" for r in got if r.doc_id < 30)


def test_empty_table(spark):
    assert personal_data(docs(spark, [(1, "x")]).where("false")).count() == 0


def plain_scores(edges, seeds, rounds, smoothing):
    """The rounds over the pattern-instance graph with dictionaries."""
    trust, scores = {s: dict(kinds) for s, kinds in seeds.items()}, {}
    totals, degree = defaultdict(float), defaultdict(float)
    for (p, i), n in edges.items():
        totals[p] += n
        degree[i] += n
    for _ in range(rounds):
        good, support = defaultdict(float), defaultdict(int)
        for (p, i), n in edges.items():
            for kind, t in trust.get(i, {}).items():
                good[p, kind] += n * t
                support[p, kind] += t == 1
        scores = {(p, k): (g / (totals[p] + smoothing), support[p, k]) for (p, k), g in good.items()}
        spread = defaultdict(lambda: defaultdict(float))
        for (p, i), n in edges.items():
            for (q, k), (s, _) in scores.items():
                if p == q and i not in seeds:
                    spread[i][k] += n * s
        trust = {s: dict(kinds) for s, kinds in seeds.items()} | {i: {k: min(t / degree[i], 0.99) for k, t in ks.items()} for i, ks in spread.items()}
    return scores


def test_graph_scores_against_dictionaries(spark):
    rng = random.Random(6)
    edges = {(f"p{rng.randrange(8)}", f"i{rng.randrange(25)}"): rng.randint(1, 4) for _ in range(90)}
    seeds = {f"i{k}": {rng.choice(["phone", "email"]): 1.0} for k in range(8)}
    frame = spark.createDataFrame([(p, i, n) for (p, i), n in edges.items()], "pattern string, instance string, n long")
    known = spark.createDataFrame([(i, k) for i, ks in seeds.items() for k in ks], "instance string, kind string")
    for rounds in (1, 3):
        got = {(r.pattern, r.kind): (r.score, r.support) for r in pii.score_patterns(frame, known, rounds, 2.0).collect()}
        want = plain_scores(edges, seeds, rounds, 2.0)
        assert got.keys() == want.keys()
        assert all(abs(got[x][0] - want[x][0]) < 1e-9 and got[x][1] == want[x][1] for x in want)


def test_precision_and_recall_on_planted_identifiers(spark):
    """Identifiers of no fixed pattern in the contexts of known ones are found; the same forms elsewhere are left alone."""
    rng = random.Random(8)
    contexts = [("phone", "please call me {} now"), ("phone", "my new number is {} since"), ("email", "write to me at {} today")]
    rows, planted, i = [], set(), 0
    for kind, context in contexts:
        for k in range(20):
            known = f"+1 ({200 + k}) 555-{1000 + i}" if kind == "phone" else f"u{k}@site{i}.org"
            rows.append((i, f"{sentence(i, 8)} {context.format(known)} {sentence((i, 1), 6)}"))
            i += 1
        for k in range(25):
            unknown = f"0{rng.randint(100, 999)}/{rng.randint(100, 999)}-{rng.randint(1000, 9999)}" if kind == "phone" else f"{sentence((k, 2), 1)}@{sentence((k, 3), 1)}"
            text = f"{sentence(i, 8)} {context.format(unknown)} {sentence((i, 1), 6)}"
            at = text.index(unknown)
            rows.append((i, text))
            planted.add((i, f"{kind}:{at}:{at + len(unknown)}"))
            i += 1
    for _ in range(60):  # numbers of the same form in other contexts
        rows.append((i, f"{sentence(i, 8)} 0{rng.randint(100, 999)}/{rng.randint(100, 999)}-{rng.randint(1000, 9999)} {sentence((i, 1), 6)}"))
        i += 1
    texts = dict(rows)
    found = {(r.doc_id, s) for r in run(spark, rows) for s in r.spans.split(",") if s} - {(d, s) for d, t in texts.items() for s in brute(t)}
    right = len(found & planted)
    assert right >= 0.95 * len(planted) and right >= 0.95 * len(found), (right, len(found), len(planted))
