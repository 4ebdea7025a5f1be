"""Scripts, micro-batches and containment beside plain Python."""

import itertools
import random

import pytest

from weftline.operators import batches, containment, script

S, C, P, N, G = script.SPEECH, script.CHOICE, script.PLAYER, script.NARRATION, script.PRESENT
KIND = "group_no long, idx int, kind string, speaker string, choice_group int, text string"


def quoted(t):
    return len(t) >= 2 and t[0] == t[-1] == '"'


def event(line, own):
    i, kind, speaker, _, t = line
    if kind == S and speaker == own:
        return (True, t, [i])
    shown = {N: f"({t})", G: f"(gift: {t})", P: t}.get(kind) or (f"{speaker}: {t}" if speaker else f"({t})")
    return (False, shown, [i])


def forks(lines, own, by_group):
    """The script as a list of steps, each a list of ways, each a list of events."""
    steps, k = [], 0
    while k < len(lines):
        if lines[k][1] != C:
            steps.append([[event(lines[k], own)]])
            k += 1
            continue
        end = k
        while end < len(lines) and lines[end][1] in (C, P):
            end += 1
        block, stop = [x for x in lines[k:end] if x[1] == C], end
        if not by_group:
            steps.append([[(False, x[4][1:-1].strip() if quoted(x[4]) else x[4], [x[0]])] for x in block])
        else:
            while stop < len(lines) and lines[stop][3] > 0 and lines[stop][1] != C:
                stop += 1
            ways = []
            for g in dict.fromkeys(x[3] for x in block):
                mine = [x for x in block if x[3] == g]
                said = " ".join(x[4][1:-1].strip() if quoted(x[4]) else f"({x[4]})" for x in mine)
                ways.append([(False, said, [x[0] for x in mine])] + [event(x, own) for x in lines[end:stop] if x[3] == g])
            steps.append(ways)
        k = stop
    return steps


def plain(lines, own, by_group):
    """Every path is walked; of equal exchanges that of the first path counts, the last choices varying slowest."""
    lines = [x for x in lines if x[1] in script.KINDS and x[4]]
    found, rest = {}, {}
    for ways in itertools.product(*reversed(forks(lines, own, by_group))):
        runs, answer = [], None
        for mine, said, keys in itertools.chain(*reversed(ways)):
            if not runs or (answer and not mine):
                runs.append(([], [], [], []))
            answer = mine
            items, at, words, spoken = runs[-1]
            (words if mine else items).append(said)
            (spoken if mine else at).extend(keys)
        done = [(tuple(i), " ".join(w)) for i, _, w, _ in runs]
        for n, (items, at, words, spoken) in enumerate(runs):
            before = done[n - 1] if n else (None, None)
            if words:
                earlier = tuple(done[max(0, n - 4) : n - 1]) if n else ()
                found.setdefault((tuple(items), tuple(spoken), *before), (tuple(at) + tuple(spoken), " ".join(words), earlier))
            else:
                rest[tuple(items), tuple(at), before[1], before[0] or ()] = True
    return sorted((i, k, a, p, pi or (), e) for (i, _, pi, p), (k, a, e) in found.items()), sorted(rest, key=repr)


def rows_of(rng, n):
    out = []
    for i in range(n):
        kind = rng.choice([S, S, S, C, C, P, N, G, "other"])
        text = rng.choice(["a", "b", "c c", '"q"', '" r "', f"t{i}", f"u{i}", ""])
        out.append((i, kind, rng.choice(["hero", "hero", "elf", None, ""]), rng.choice([0, 0, 1, 1, 2, 2, 3]), text))
    return out


def got(df, rest):
    ex = {}
    for r in df.collect():
        earlier = tuple((tuple(e["user"]), e["answer"]) for e in r["earlier"])
        ex.setdefault(r["group_no"], []).append((tuple(r["user_items"]), tuple(r["keys"]), r["answer"], r["previous"], tuple(r["previous_items"] or ()), earlier))
    un = {}
    for r in rest.collect():
        un.setdefault(r["group_no"], []).append((tuple(r["items"]), tuple(r["keys"]), r["previous"], tuple(r["previous_items"])))
    return ex, un


@pytest.mark.parametrize("by_group", [True, False])
def test_walk_beside_every_path(spark, by_group):
    rng = random.Random(4 + by_group)
    scripts = {g: rows_of(rng, rng.randrange(1, 15)) for g in range(70)}
    scripts[500] = [(i, C if i % 2 else P, "", 1 + i % 3, f"o{i}") for i in range(9)]
    scripts[501] = [(i, C if i % 3 == 0 else S if i % 3 == 1 else N, "hero", 1, f"w{i}") for i in range(40)]
    lines = spark.createDataFrame([(g, *r) for g, rows in scripts.items() for r in rows], KIND)
    ex, un = got(*script.walked(lines, "hero", by_group=by_group))
    order = lambda rows: sorted(rows, key=repr)
    for g, rows in scripts.items():
        want, left = plain(rows, "hero", by_group)
        assert order(ex.get(g, [])) == order(want), (g, rows)
        assert order(un.get(g, [])) == order(left), (g, rows)


def test_walk_of_odd_scripts(spark):
    lines = spark.createDataFrame([(None, 1, S, "hero", 0, "x"), (1, 1, S, "hero", None, "only"), (2, 1, N, None, 0, None), (3, 1, "odd", "hero", 0, "x")], KIND)
    ex, un = got(*script.walked(lines, "hero"))
    assert ex == {1: [((), (1,), "only", None, (), ())]} and un == {}
    assert sorted((r["group_no"], r["kind"]) for r in script.unconverted(lines).collect()) == [(2, N), (3, "odd")]
    ex, un = got(*script.walked(lines.limit(0), "hero"))
    assert ex == un == {}


def greedy(widths, most, budget):
    out, n, wide = [], 0, 0
    for w in widths:
        if n and (n == most or (n + 1) * max(wide, w) > budget):
            out.append((n, wide))
            n, wide = 0, 0
        n, wide = n + 1, max(wide, w)
    return [*out, (n, wide)] if n else out


@pytest.mark.parametrize(("most", "chunk"), [(1, 1), (3, 3), (4, 7), (8, 16), (5, 1 << 16)])
def test_batches_in_chunks_of_any_size(spark, most, chunk):
    rng = random.Random(most)
    owners = {"a": 200, "b": 1, None: chunk if chunk < 50 else 33, "c": 2 * chunk + 1 if chunk < 50 else 9, "d": most}
    rows = [(o, i, rng.choice([None, 0, 1, 5, 20, 60, 900])) for o, n in owners.items() for i in range(n)]
    rng.shuffle(rows)
    found = batches.micro_batches(spark.createDataFrame(rows, "owner string, id long, w int"), "owner", "id", "w", most, 100, chunk=chunk).collect()
    for o in owners:
        widths = [w or 0 for _, w in sorted((i, w) for p, i, w in rows if p == o)]
        assert sorted((r["batch"], r["n"], r["width"]) for r in found if r["owner"] == o) == [(k, *b) for k, b in enumerate(greedy(widths, most, 100))], o
    assert batches.micro_batches(spark.createDataFrame([], "owner string, id long, w int"), "owner", "id", "w", most, 100, chunk=chunk).count() == 0


def test_no_task_holds_an_owner(spark, monkeypatch):
    """Forty chunks of one owner: each call of the kernel gets a chunk and the rows behind it."""
    rows = spark.range(2000).selectExpr("1L AS owner", "id", "cast(xxhash64(id) % 50 + 50 AS int) AS w")
    widths = [r["w"] for r in rows.orderBy("id").collect()]
    found = batches.micro_batches(rows, "owner", "id", "w", 8, 300, chunk=50).orderBy("batch").collect()
    assert [(r["n"], r["width"]) for r in found] == greedy(widths, 8, 300)


def test_items_of_every_length_are_found(spark):
    rng = random.Random(8)
    letters = "abé日 \n"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    docs = [(i, word(rng.choice([0, 1, 3, 10, 30, 200, 3000]))) for i in range(60)] + [(None, "abcabc"), (7, None), (3, word(50)), (70, "z" * 5000)]
    long = word(10_000)
    docs.append((99, "x" + long + "y"))
    items = [(900, long), (901, long[5:]), (902, "z" * 40), (903, "z" * 5001), (904, None), (905, ""), (906, "word"), (907, "bca")]
    for k in range(150):
        t = rng.choice(docs)[1] or "q"
        n = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 20, 24, 25, 60, 500])
        a = rng.randrange(max(1, len(t) - n + 1))
        items.append((k, t[a : a + n] + rng.choice(["", "", "", "!"])))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((i, k) for i, t in docs for k, x in items if t and x and x in t), key=repr)
    assert sorted(map(tuple, containment.containing(d, it).collect()), key=repr) == want
    assert containment.containing(d, it.limit(0)).count() == 0
    assert containment.containing(d.limit(0), it).count() == 0


def test_texts_in_pieces_select_the_same(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = [containment.selected(text, q, w).tolist() for _, q, w in containment.CLASSES]
    monkeypatch.setattr(containment, "PIECE", 64)
    assert [containment.selected(text, q, w).tolist() for _, q, w in containment.CLASSES] == whole
