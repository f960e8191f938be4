"""Removed lines equal brute force; sketches far from the threshold agree with exact counts."""

from pyspark.sql import functions as F

from tidemark.llm import line_dedup as ld

WHITE = " \t\n\r\x0b\x0c"


def brute(rows, min_sites, min_words=3):
    """rows: (id, text, site) -> the texts left, by row."""
    low = -(2**63)
    sites, first = {}, {}
    for i, text, site in rows:
        for at, raw in enumerate(text.split("\n") if text is not None else []):
            line = raw.strip(WHITE)
            if len(line.replace("\t", " ").split()) >= min_words:
                if site is not None:
                    sites.setdefault(line, set()).add(site)
                place = (low if i is None else i, at)
                first[line] = min(first.get(line, place), place)
    common = {line for line, s in sites.items() if len(s) >= min_sites}
    out = []
    for i, text, site in rows:
        kept = [raw for at, raw in enumerate(text.split("\n") if text is not None else [])
                if raw.strip(WHITE) not in common or first[raw.strip(WHITE)] == (low if i is None else i, at)]
        out.append(None if text is None else "\n".join(kept))
    return out


def test_edge_cases(spark):
    note = "all rights are reserved"
    rows = [(i, f"own line number {i} here\n  {note}\t\nshort one\n{note}\n", f"s{i % 5}") for i in range(40)]
    rows += [(100, None, "s1"), (101, "", "s2"), (102, note, None), (103, note, "s9"), (None, f"x y z\n{note}", "s3"),
             (104, "rare line here now", "s1"), (105, "rare line here now", "s2"), (106, "\n\n", "s1"), (106, "\n\n", "s1"),
             (107, "\r\nrare line here now\r\n", "s3")]
    frame = spark.createDataFrame([(*r, 5, "g") for r in rows], "doc_id long, text string, source string, n_chars int, gone string")
    for min_sites in (2, 3, 4, 7):
        got = ld.remove_boilerplate(frame, min_sites=min_sites, chars="n_chars")
        assert got.columns == frame.columns and dict(got.dtypes)["n_chars"] == "int"
        found = [(r["doc_id"], r["source"], r["text"], r["n_chars"]) for r in got.collect()]
        want = [(r[0], r[2], t, None if t is None else len(t)) for r, t in zip(rows, brute(rows, min_sites))]
        assert sorted(found, key=repr) == sorted(want, key=repr)
    assert ld.remove_boilerplate(spark.createDataFrame([], frame.schema)).collect() == []


def test_sketch_and_exact_band(spark):
    """Lines on 1 to 400 sites against a threshold of 100: the band is counted exactly."""
    rows = [(n, s) for n in range(1, 401, 3) for s in range(n)]
    lines = spark.createDataFrame(rows, "line long, site long").selectExpr(
        "unhex(md5(cast(line AS string))) AS line", "line AS n", "cast(site AS string) AS site")
    common = ld.boilerplate(lines, 100, registers=8).join(lines.select("line", "n").distinct(), "line")
    assert sorted(r["n"] for r in common.collect()) == [n for n in range(1, 401, 3) if n >= 100]
    assert common.groupBy("line").count().where(F.col("count") > 1).count() == 0
