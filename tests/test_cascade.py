"""The full-length rules against the same rules taken one structure and one model at a time."""

import random

from pyspark.sql import functions as F

from strandloom.functions.seq import protein_identity
from strandloom.operators import assemble, cascade

PARTS = "array<struct<lend:int,rend:int>>"


def slow_identity(a, b):
    above = [(-2 * j, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [(-2 * i, 0)]
        for j, y in enumerate(b, 1):
            s, k = above[j - 1]
            row.append(max((s + (2 if x == y else -1), k + (x == y)), (above[j][0] - 2, above[j][1]), (row[-1][0] - 2, row[-1][1])))
        above = row
    return 100 * above[-1][1] / max(len(a), len(b))


def test_protein_identity():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("MKV*") for _ in range(rng.randrange(1, 25))) for _ in range(2))
        assert protein_identity(a, b) == slow_identity(a, b)


def structure(rng, start=None):
    at, out = rng.randrange(0, 150) if start is None else start, []
    for _ in range(rng.randrange(1, 4)):
        out.append((at, at + rng.choice([20, 30])))
        at = out[-1][1] + rng.choice([20, 30])
    return out


def test_compatible_columns_equal_the_function(spark):
    rng = random.Random(2)
    rows = [(structure(rng, rng.choice([0, 5, 30, 50])), structure(rng, rng.choice([0, 20, 50]))) for _ in range(600)]
    df = spark.createDataFrame(rows, f"a {PARTS}, b {PARTS}")
    got = [r.x for r in df.coalesce(1).select(cascade.compatible(F.col("a"), F.col("b")).alias("x")).collect()]
    want = [assemble.compatible(a, b) for a, b in rows]
    assert got == want and 20 < sum(want) < 580


def greedy(edges):
    u_taken, v_taken, out = set(), set(), []
    for u, v, takes in sorted(edges):
        if u in u_taken or v in v_taken:
            continue
        out.append((u, v, takes))
        v_taken.add(v)
        if takes:
            u_taken.add(u)
    return out


def test_matching_in_rounds_equals_one_pass(spark):
    rng = random.Random(1)
    edges = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(200)})
    edges = [(u, v, rng.random() < 0.7) for u, v in edges]
    got = cascade.matched(spark.createDataFrame(edges, "u int, v int, t boolean"), "u", "v", "t")
    assert sorted(map(tuple, got.collect())) == greedy(edges)
    assert cascade.matched(spark.createDataFrame([], "u int, v int"), "u", "v").count() == 0
    # of several groups at once, as a stream
    many = [(g, 100 * g + u, 100 * g + v, t) for g in range(5) for u, v, t in edges[g::2]]
    df = spark.createDataFrame(many, "g int, u int, v int, t boolean").repartition(3)
    assert sorted(map(tuple, cascade.matched_within(df, ["g"], "u", "v", "t").collect())) == sorted(greedy([e[1:] for e in many]))
    assert cascade.matched_within(df.where("false"), ["g"], "u", "v").count() == 0


def alike(a, b):
    return bool(a and b) and 100 * min(len(a), len(b)) / max(len(a), len(b)) >= 70 and slow_identity(a, b) >= 70


def one_by_one(structures, models):
    """structures: acc -> (exons, cds, protein, cdna); models: (gene, model) -> (exons, cds, protein), all of one contig and strand."""
    out, of_gene, novel = {}, {}, []
    meet = lambda x, y: any(assemble.meets(p, q) for p in x for q in y)
    for acc, (exons, cds, protein, cdna) in sorted(structures.items()):
        run = most = 0
        for e in exons:
            run = 0 if any(assemble.meets(e, c) for c in cds) else run + 1
            most = max(most, run)
        if not (protein.startswith("M") and protein.endswith("*")):
            out[acc] = (None, None)
        elif 300 * len(protein) < 40 * len(cdna) or most > 2:
            out[acc] = (1, None)
        else:
            genes = {g for (g, _), m in models.items() if meet(exons, m[0])}
            if len(genes) > 1:
                out[acc] = (5, None)
            elif genes:
                of_gene.setdefault(genes.pop(), []).append(acc)
            else:
                novel.append(acc)
    reach, seen = -1, []
    for acc in sorted(novel, key=lambda a: (structures[a][0][0][0], structures[a][0][-1][1], a)):
        if structures[acc][0][0][0] > reach:
            seen.append([])
        reach = max(reach, structures[acc][0][-1][1])
        seen[-1].append(acc)
    for pile in seen:
        for acc in pile:
            out[acc] = (10 if acc == min(pile) else 44, None)
    for g, accs in of_gene.items():
        own = sorted(m for gg, m in models if gg == g)
        took, gave, demoted, updated = {}, {}, set(), set()
        for m in own:
            for a in accs:
                if m in took or a in gave or a in demoted:
                    continue
                x, y = structures[a][0], models[g, m][0]
                if assemble.compatible(y, x):
                    if x[0][0] > y[0][0] or x[-1][1] < y[-1][1]:
                        demoted.add(a)
                    else:
                        took[m], gave[a] = a, m
        for a in accs:
            if a in demoted:
                out[a] = (None, None)
            if a in gave:
                m = gave[a]
                (x, xc, xp, _), (y, yc, yp) = structures[a], models[g, m]
                s = 3 if x == y and xc == yc else 4 if xc == yc else 6 if alike(yp, xp) else 7
                out[a] = (s, m)
                if s != 7:
                    updated.add(m)

        def cover(a, m):
            (_, xc, _, _), (_, yc, _) = structures[a], models[g, m]
            return bool(xc and yc) and 100 * max(0, min(xc[-1][1], yc[-1][1]) - max(xc[0][0], yc[0][0]) + 1) >= 80 * (yc[-1][1] - yc[0][0] + 1)

        for test, code in ((lambda a, m: alike(models[g, m][2], structures[a][2]), 8), (lambda a, m: len(structures[a][0]) > 1 and cover(a, m), 26)):
            for a in accs:
                m = None if a in out else next((m for m in own if m not in updated and test(a, m)), None)
                if m is not None:
                    out[a] = (code, m)
                    updated.add(m)
        for a in accs:
            if a not in out:
                near = [m for m in own if alike(models[g, m][2], structures[a][2])]
                over = [m for m in own if cover(a, m)]
                out[a] = (23, None) if len(updated) < len(own) else (9, near[0]) if near else (33, over[0]) if over else (21, None)
    return out


def test_statuses_against_one_at_a_time(spark):
    rng = random.Random(5)
    proteins = ["M" + "".join(rng.choice("KVALDE") for _ in range(20)) + "*" for _ in range(3)]
    near = [p[:5] + "W" + p[6:] for p in proteins]
    seen = set()
    rows, models, want = [], [], {}
    for contig in range(60):
        spots = [0, 60, 150, 400]
        coding = lambda e: e[:1] if rng.random() < 0.2 else e
        mine = {}
        for k in range(rng.randrange(0, 4)):
            e = structure(rng, rng.choice(spots[:3]))
            mine[f"g{e[0][0] // 100 if rng.random() < 0.9 else 9}", f"m{k}"] = (e, coding(e), rng.choice(proteins + near))
        own = {}
        for k in range(rng.randrange(1, 6)):
            if mine and rng.random() < 0.5:
                e, c, p = rng.choice(list(mine.values()))
                if rng.random() < 0.5:
                    e = [(e[0][0] - 3, e[0][1]), *e[1:-1], (e[-1][0], e[-1][1] + 3)] if len(e) > 1 else e
            else:
                e = structure(rng, rng.choice(spots))
                c, p = coding(e), rng.choice([*proteins, *near, "MK", "M" + "".join(rng.choice("STNQ") for _ in range(21)) + "*", "M*"])
            own[10 * contig + k] = (e, c, p, "A" * rng.choice([60, 60, 60, 900]))
        got = one_by_one(own, mine)
        want |= got
        seen |= {s for s, _ in got.values()}
        rows += [(contig, a, "+", *v) for a, v in own.items()]
        models += [(contig, g, m, "+", *v) for (g, m), v in mine.items()]
    s = spark.createDataFrame(rows, f"contig int, acc int, strand string, exons {PARTS}, cds {PARTS}, protein string, cdna string")
    m = spark.createDataFrame(models, f"contig int, gene_id string, model_id string, strand string, exons {PARTS}, cds {PARTS}, protein string")
    got = cascade.full_length_statuses(s, m).collect()
    assert len(got) == len(want) and {r.acc: (r.status, r.model_id) for r in got} == want
    assert seen >= {None, 1, 3, 4, 5, 6, 8, 9, 10, 21, 23, 26, 44}
