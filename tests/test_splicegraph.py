"""The splice-graph assembler against all paths of small graphs, and by hand."""

import random

from strandloom.operators import splicegraph as sg


def made(rng):
    """Structures over a few shared sites."""
    grid = [(100 * k, 100 * k + rng.choice([40, 40, 50])) for k in range(6)]
    out = []
    for _ in range(rng.randrange(1, 9)):
        own = [grid[k] for k in sorted(rng.sample(range(6), rng.randrange(1, 5)))]
        s = [list(e) for e in own]
        s[0][0] += rng.choice([0, 5, 30])
        s[-1][1] -= rng.choice([0, 5, 25])
        if rng.random() < 0.2 and len(s) > 1:
            s[0][1] -= 10
        out.append([tuple(e) for e in s if e[0] <= e[1]])
    return [s for s in out if s]


def all_paths(exons, structures):
    """Every walk from exon to exon over an intron that some structure has, from no way in to no way out."""
    gaps = {g for s in structures for g in sg.introns(s)}
    nexts = {a: [b for b, y in enumerate(exons) if (exons[a][1] + 1, y[0] - 1) in gaps and exons[a][2] != sg.RIGHT and y[2] != sg.LEFT] for a in range(len(exons))}
    begins = set(nexts) - {b for bs in nexts.values() for b in bs}
    todo = [[b] for b in begins]
    while todo:
        p = todo.pop()
        if not nexts[p[-1]]:
            yield p
        todo += [[*p, b] for b in nexts[p[-1]]]


def test_best_paths_against_all_paths():
    rng = random.Random(9)
    for _ in range(300):
        structures = made(rng)
        many = [s for s in structures if len(s) > 1]
        exons = sg.exons_of(many)
        paths = list(all_paths(exons, structures))
        score = {tuple(p): sg.path_score(p, exons, structures) for p in paths}
        up, down = sg.best_paths(exons, structures)
        for k in range(len(exons)):
            with_k = [p for p in paths if k in p]
            best = max(score[tuple(p)] for p in with_k)
            whole = [*up[k][1], *down[k][1][1:]]
            assert up[k][0] + down[k][0] == best == score[tuple(whole)]
        for s in many:
            got = sg.through(s, exons, up, down, lambda p: sg.path_score(p, exons, structures))
            best = max(score[tuple(p)] for p in paths if sg.holds([exons[k] for k in p], s))
            assert got[0] == best == score[tuple(got[1])]


def test_everything_is_held():
    rng = random.Random(10)
    for _ in range(300):
        structures = made(rng)
        found = sg.assemble_graph(structures)
        assert set().union(*(m for _, m in found)) == set(range(len(structures)))
        for segments, members in found:
            assert all(a[1] < b[0] for a, b in zip(segments, segments[1:]))
            for n in members:
                s = structures[n]
                inside = set(sg.introns(segments))
                assert set(sg.introns(s)) <= inside and s[0][0] >= segments[0][0] - 20 and s[-1][1] <= segments[-1][1] + 20


def test_nodes_by_hand():
    a, b = [(100, 200), (300, 400), (500, 600)], [(250, 400), (500, 550)]
    # the left end of b passes the inner exon by more than the fuzz, so it is a node of its own; its right end is a's
    assert sg.exons_of([a, b]) == [(100, 200, sg.LEFT), (250, 400, sg.LEFT), (300, 400, sg.INNER), (500, 600, sg.RIGHT)]
    # 285 lies within it
    assert sg.exons_of([a, [(285, 400), (500, 550)]]) == [(100, 200, sg.LEFT), (300, 400, sg.INNER), (500, 600, sg.RIGHT)]
    # an end on the right that reaches into one on the left: an inner exon between their sites
    x, y = [(10, 50), (100, 180)], [(150, 220), (300, 350)]
    assert (100, 220, sg.INNER) in sg.exons_of([x, y])
    assert sg.assemble_graph([x, y]) == [([(10, 50), (100, 220), (300, 350)], [0, 1])]


def test_two_forms_and_singles(spark):
    rows = [
        (1, 1, "+", [(100, 200), (300, 400), (500, 600)]), (1, 2, "+", [(100, 200), (500, 600)]), (1, 3, "+", [(150, 200), (300, 350)]), (1, 4, "?", [(320, 380)]),
        (1, 5, "-", [(100, 600)]), (1, 6, "+", [(100, 200), (500, 600)]), (2, 7, "+", [(1, 50)]), (2, 8, "+", [(40, 90)]),
    ]
    df = spark.createDataFrame(rows, "contig int, acc int, strand string, segments array<struct<lend:int,rend:int>>")
    got = sorted(map(tuple, sg.graph_assemblies(df).collect()))
    assert got == [
        (1, 1, "+", 1, "1,3,4", 3, "100-200,300-400,500-600"), (1, 1, "+", 2, "2,6", 2, "100-200,500-600"),
        (1, 1, "-", 1, "5", 1, "100-600"), (2, 1, "+", 1, "7,8", 2, "1-90"),
    ]
    assert sg.graph_assemblies(df.where("false")).count() == 0


def test_evidence_is_gathered_once(monkeypatch):
    calls, inner = [], sg._evidence
    monkeypatch.setattr(sg, "_evidence", lambda *a: calls.append(1) or inner(*a))
    sg.assemble_graph([[(1, 50), (100, 150), (200, 250)], [(10, 50), (200, 240)], [(120, 150), (200, 230)]])
    assert len(calls) == 1
