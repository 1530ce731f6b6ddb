from llm_helpers import docs
from ratelake.llm.line_dedup import drop_boilerplate


def brute(rows, ratio, least):
    hosts = {}
    for _, text, _, host in rows:
        if text is not None:
            hosts.setdefault(host or "", set()).add(text)
    bad = {}
    for host, texts in hosts.items():
        counts = {}
        for t in texts:
            for line in {x.strip(" ") for x in t.split("\n")} - {""}:
                counts[line] = counts.get(line, 0) + 1
        bad[host] = {x for x, n in counts.items() if n >= least and n > ratio * len(texts)}
    return [
        (i, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad[h or ""]))
        for i, t, _, h in rows
    ]


def test_against_brute_force(spark):
    rows = []
    for i in range(60):
        lines = [f"own {i}", "", "menu" if i % 2 else f"other {i}", f"  footer {i % 3}  ", "rare" if i < 4 else "x" + str(i)]
        rows.append((i, "\n".join(lines), "en", ["a", "b", None][i % 3]))
    rows += [(100 + i, "copied page\nwith two lines", "en", "a") for i in range(50)]
    rows += [(7, None, "en", "a"), (None, "menu", "en", ""), (8, "", "en", "a"), (9, "menu\nmenu\nend", None, "a"), (9, "menu\nmenu\nend", None, "a")]
    table = docs(spark, rows)
    out = drop_boilerplate(table, max_ratio=0.2, min_pages=5, n_lines="n_lines", n_dropped="gone")
    assert out.columns == table.columns + ["n_lines", "gone"]
    got = out.collect()
    assert sorted(((str(r.doc_id), r.text) for r in got), key=str) == sorted(((str(i), t) for i, t in brute(rows, 0.2, 5)), key=str)
    assert any("copied page" in (r.text or "") for r in got)  # copies are one page
    assert all(r.gone == 0 and r.n_lines == 0 for r in got if r.text is None)


def test_empty_table(spark):
    assert drop_boilerplate(docs(spark, [(1, "x", "en", "a")]).where("false")).count() == 0


def test_the_ratio_decides_on_hosts_of_any_size(spark):
    rows = [(i, f"top\nown {i}\n" + ("pair" if i < 2 else f"single {i}"), "en", "four") for i in range(4)]
    rows += [(100 + i, "\n".join([f"own {i}", "two" if i < 2 else f"x {i}", "three" if i < 3 else f"y {i}"]), "en", "hundred") for i in range(100)]
    got = {r.doc_id: r.text for r in drop_boilerplate(docs(spark, rows)).collect()}
    assert got == dict(brute(rows, 0.02, 2))
    assert got[0] == "own 0" and got[3] == "own 3\nsingle 3"  # half of a small host's pages is enough, one page isn't
    assert "two" in got[100] and "three" not in got[100]  # 2 % exactly is not above 2 %


def test_many_bad_lines_and_very_long_pages(spark):
    common = "\n".join(f"common {i}" for i in range(20_000))
    rows = [(i, f"{common}\nown {i}", "en", "a") for i in range(3)] + [(9, "x" * 2_000_000, "en", "a"), (10, "\n" * 100_000, "en", "a")]
    got = {r.doc_id: r.text for r in drop_boilerplate(docs(spark, rows)).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 9: "x" * 2_000_000, 10: "\n" * 100_000}
