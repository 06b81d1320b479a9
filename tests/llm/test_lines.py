import pytest
from hypothesis import given, settings, strategies as st

from helpers import documents, rng, words
from weatherlake.llm import lines as module
from weatherlake.llm.lines import dedup_lines, edit_distance, similar


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + row[1:], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=40), st.text("abc", max_size=40), st.integers(0, 40))
def test_edit_distance(a, b, most):
    true = plain_distance(a, b)
    got = edit_distance(a, b, most)
    assert got == true if true <= most else got > most


def test_first_of_a_group_stays(spark):
    r = rng(1)
    long = [" ".join(words(r, 40)) for _ in range(4)]
    changed = long[0].split()
    changed[20] = "changed"
    rows = [(1, f"{long[0]}\n{long[1]}\n***\n{long[0].upper()}!"), (2, f"{' '.join(changed)}\n{long[2]}\n***"),
            (3, f"{long[2]}.\n\n{long[3]}")]
    got = {x.doc_id: (x.text, x.lines_removed) for x in dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: (f"{long[0]}\n{long[1]}\n***", 1), 2: (f"{long[2]}\n***", 1), 3: (f"\n{long[3]}", 1)}


def test_recall_of_edited_lines(spark):
    r = rng(2)
    rows = []
    for k in range(150):
        line = words(r, r.randint(25, 60))
        rows.append((2 * k, " ".join(line)))
        line[r.randrange(len(line))] = "other"
        rows.append((2 * k + 1, " ".join(line)))
    kept = dedup_lines(documents(spark, rows)).filter("lines_removed = 0").count()
    assert 150 <= kept <= 150 + 15  # at least 90 % of the edited copies are found


def test_groups_match_brute_force_on_exact_and_near_lines(spark):
    r = rng(4)
    pool = [" ".join(words(r, r.randint(1, 30))) for _ in range(30)]
    rows = [(k, "\n".join(r.choice(pool) for _ in range(5))) for k in range(40)]
    got = {x.doc_id: x.text for x in dedup_lines(documents(spark, rows)).collect()}
    group, out, seen = {}, {}, set()
    for p in pool:
        group[p] = next((q for q in group if group[q] == q and similar(p.lower(), q.lower(), 0.9)), p)
    for k, t in rows:
        keep = []
        for line in t.split("\n"):
            if group[line] not in seen:
                keep.append(line)
                seen.add(group[line])
        out[k] = "\n".join(keep)
    assert got == out


def test_edge_cases(spark):
    huge = " ".join(words(rng(5), 30000))
    rows = [(None, "first line of all"), (1, None), (2, ""), (3, "\n\n"), (4, "first line of all"), (5, huge), (5, huge), (6, huge + " x")]
    df = documents(spark, rows).selectExpr("*", "7 as lines_removed", "'v' as id", "1 as number", "2 as _numbers_")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "id", "number", "_numbers_", "lines_removed"]
    found = sorted(((x.doc_id, x.text, x.lines_removed) for x in got.collect()), key=str)
    assert found == sorted([(None, "first line of all", 0), (1, None, 0), (2, "", 0), (3, "\n\n", 0), (4, "", 1), (5, huge, 0), (5, huge, 0),
                            (6, "", 1)], key=str)
    assert dedup_lines(documents(spark, [])).count() == 0


def test_hot_line(spark):
    rows = [(k, f"the line that a third of all documents share\n{' '.join(words(rng(k), 20))}") for k in range(300)]
    got = {x.doc_id: x.lines_removed for x in dedup_lines(documents(spark, rows)).collect()}
    assert got[0] == 0 and all(got[k] == 1 for k in range(1, 300))


def one_letter(r, line):
    at = r.choice([k for k, c in enumerate(line) if c != " "])
    return line[:at] + r.choice("xyz") + line[at + 1:]


@pytest.mark.parametrize("least, most, recall", [(1, 1, 1.0), (2, 2, 1.0), (3, 5, 1.0), (6, 10, 1.0), (11, 20, 0.9), (21, 60, 0.95)])
def test_recall_by_length(spark, least, most, recall):
    """One letter changed, similarity still 0.9 or more."""
    r = rng(1000 + least)
    rows = []
    while len(rows) < 400:
        line = " ".join(words(r, r.randint(least, most)))
        other = one_letter(r, line)
        if similar(line, other, 0.9) and line != other:
            rows += [(len(rows), line), (len(rows) + 1, other)]
    kept = dedup_lines(documents(spark, rows)).filter("lines_removed = 0").count()
    assert kept <= 200 + 200 * (1 - recall)


def test_one_word_inserted_deleted_or_replaced_in_short_lines(spark):
    r = rng(55)
    rows = []
    for _ in range(80):
        line = ["".join(words(r, 3)) for _ in range(r.randint(4, 9))]
        other, at = list(line), r.randrange(len(line))
        kind = r.choice("idr")
        if kind == "d":
            other.insert(at, "x")
        else:
            other[at] = other[at][:-1] + "x"
        pair = (" ".join(line), " ".join(other))
        if similar(*pair, 0.9):
            rows += [(len(rows) + k, t) for k, t in enumerate(pair if r.random() < 0.5 else pair[::-1])]
    assert len(rows) > 100
    assert dedup_lines(documents(spark, rows)).filter("lines_removed = 0").count() == len(rows) // 2


def brute_groups(lines, similarity=0.9):
    group = {}
    for a in lines:
        group[a] = a
    for a in lines:
        for b in lines:
            if a < b and group[a] != group[b] and similar(a, b, similarity):
                x, y = group[a], group[b]
                for k in group:
                    if group[k] == y:
                        group[k] = x
    return len(set(group.values()))


@pytest.mark.parametrize("tile, small", [(4096, 64), (4096, 2), (16, 4)])
def test_a_large_key_in_tiles(spark, monkeypatch, tile, small):
    # one beginning and end, and a word of each line's own: near ones, far ones and chains
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "SMALL", small)
    r = rng(66)
    lines = {f"the same long beginning of the line {w} and the same end of it" for w in words(r, 60)}
    lines |= {f"the same long beginning of the line {''.join(words(r, 6))} and the same end of it" for _ in range(60)}
    rows = [(k, t) for k, t in enumerate(sorted(lines))]
    r.shuffle(rows)
    kept = dedup_lines(documents(spark, rows).repartition(3)).filter("lines_removed = 0").count()
    assert kept == brute_groups(sorted(lines))


def test_clashing_names(spark):
    df = documents(spark, [(1, "the first line of all"), (2, "the first line of all")]).selectExpr(
        "*", "1 as _id", "2 as _version", "3 as _losing", "4 as _numbers", "5 as _gid")
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "lines_removed"]
    assert sorted((x.doc_id, x.text, x._id, x._version, x._losing, x._numbers, x._gid) for x in got.collect()) == [
        (1, "the first line of all", 1, 2, 3, 4, 5), (2, "", 1, 2, 3, 4, 5)]


def test_keys_of_pieces():
    import numpy as np
    from weatherlake.llm.lines import _Sequence
    from weatherlake.llm.textarrays import U
    a, b, c = [1, 2, 3, 4], [1, 2, 4], [7]
    m = np.array([*a, *b, *c], U) * U(0x9E3779B97F4A7C15)
    out, start = _Sequence(m, np.array([0, 4, 7, 8])).lacking_one(U(5))
    keys = [set(out[i:j].tolist()) for i, j in zip(start[:-1], start[1:])]
    assert [len(k) for k in keys] == [5, 4, 2]
    assert out[start[1]] in keys[0] and len(keys[0] & keys[1]) == 1  # a without 3 is b
def test_similar_bounds():
    assert similar("", "", 0.9) and not similar("a", "", 0.9)
    assert similar("a" * 10, "a" * 9 + "b", 0.9) and not similar("a" * 9, "a" * 8 + "b", 0.9)
    with pytest.raises(TypeError):
        similar(None, "a", 0.9)


@pytest.mark.parametrize("most_length, letters", [(12, "ab"), (90, "abcé"), (900, "abc漢ÿ"), (1500, "abcd")])
def test_distances_of_many_pairs(most_length, letters):
    import numpy as np
    from weatherlake.llm.lines import _codes, within
    r = rng(77)
    pairs = []
    for _ in range(60):
        a = "".join(r.choice(letters) for _ in range(r.randint(0, most_length)))
        b = list(a)
        for _ in range(r.randint(0, most_length // 8)):
            at = r.randint(0, len(b))
            b[at:at + r.randint(0, 1)] = r.choice(["", r.choice(letters)])
        pairs.append((a, "".join(b)) if r.random() < 0.5 else ("".join(b), a))
    most = [r.randint(0, max(len(a), len(b)) // 6) for a, b in pairs]
    codes, at = _codes([x for p in pairs for x in p])
    i = np.arange(0, 2 * len(pairs), 2)
    true = [plain_distance(a, b) if len(a) < 100 else edit_distance(a, b, len(a) + len(b)) for a, b in pairs]
    near = [d <= m for d, m in zip(true, most)]
    assert within(codes, at, i, i + 1, np.array(most)).tolist() == near
    assert any(near) and not all(near)
