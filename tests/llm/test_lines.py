import hashlib
import random
import re
from collections import Counter, defaultdict

from millrace.llm.line_templates import drop_recurring_lines, op5_line_templates


def mode_of(lines, docs):
    """The most frequent word of each position, by documents."""
    mode = []
    for pos in range(len(next(iter(lines)))):
        votes = Counter()
        for words in lines:
            votes[words[pos]] += docs[words]
        mode.append(max(votes, key=lambda w: (votes[w], w.encode())))
    return mode


def agrees(words, mode):
    counted = [(a, b) for a, b in zip(words, mode) if not a == b == "<*>"]
    return 100 * sum(a == b for a, b in counted) >= 80 * len(counted)


def brute(rows):
    """Texts without recurring lines, by (id, text)."""
    filed, of = [], {}
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for d in docs:
        for no, line in enumerate((d[1] if d[1] is not None else "").split("\n")):
            own = tuple(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)
            words = tuple("<*>" if re.search("[0-9]", w) else w for w in own)
            if 2 * words.count("<*>") > len(words):
                filed.append((d, no, ("mostly variable", own)))
                of["mostly variable", own] = own
            elif words:
                filed.append((d, no, words))
    leaves = defaultdict(lambda: defaultdict(set))
    for d, _, words in filed:
        if words not in of:
            leaves[len(words), words[:3]][words].add(d)
    for leaf, lines in leaves.items():
        weight = {words: len(have) for words, have in lines.items()}
        mode = mode_of(lines, weight)
        of.update({words: (leaf, "leaf") for words in lines if agrees(words, mode)})
        left = [words for words in lines if words not in of]
        of.update({words: (leaf, words) for words in left})
        n = leaf[0]
        blocks = {}
        for words in left if n > 3 else []:
            spare = n * 20 // 100
            blocks[words] = [(j, words[3 + j * (n - 3) // (spare + 1) : 3 + (j + 1) * (n - 3) // (spare + 1)]) for j in range(spare + 1)]
        have = defaultdict(list)
        for words, own in blocks.items():
            for block in own:
                have[block].append(words)
        chosen = defaultdict(list)
        for words, own in blocks.items():
            shared = [b for b in own if len(have[b]) > 1]
            if shared:
                chosen[max(shared, key=lambda b: (sum(weight[w] for w in have[b]), -b[0]))].append(words)  # noqa: B023
        for block, lines_of in chosen.items():
            child = mode_of(lines_of, weight)
            fits = [words for words in lines_of if agrees(words, child)]
            if len(fits) > 1:
                of.update({words: (leaf, "child", block) for words in fits})
    have = defaultdict(list)
    for d, _, words in filed:
        if d not in have[of[words]]:
            have[of[words]].append(d)
    gone = defaultdict(set)
    for d, no, words in filed:
        if len(have[of[words]]) > 1 and d != have[of[words]][0]:
            gone[d].add(no)
    return {d: (d[1] if d[1] is None else "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]), len(gone[d])) for d in docs}


LOG = "there was a login by {} from host {} after {} failed attempts today"
ROWS = [
    (1, "own first line of this very document here\n" + LOG.format("ann", "h1", 3) + "\nshort line\n"),
    (2, LOG.format("bob", "h2", 14) + "\nshort line\nanother line that no other document has got"),
    (3, "before\n" + LOG.format("ann", "h9", 7) + "\n" + LOG.format("eve", "h9", 7) + "\nafter"),
    (4, "user ann logged out and then came back to see what was new"),
    (5, "the licence of this text is free for all to use\nmiddle\nthe  licence of this\ttext is free for all to use"),
    (6, "the licence of this text is free for all to use"),
    (6, "the licence of this text is free for all to use"),
    (7, "The licence of this text is free for all to use"),
    (8, None), (9, ""), (10, "\n\n"), (None, "the licence of this text is free for all to use\nkept"), (11, "é" * 5000 + " 1" * 50),
]


def families(seed=1):
    """Several families of lines in one leaf, each with variable words, short lines, numbers, and lines of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    kinds = [["we", "saw", "that", *[word() for _ in range(n)]] for n in (9, 9, 9, 9, 17, 17, 2, 1)]
    rows = []
    for i in range(90):
        lines = []
        for kind in rng.sample(kinds, 3):
            line = list(kind)
            for _ in range(rng.randint(0, max(1, len(line) // 5))):
                line[rng.randrange(3, len(line))] = rng.choice([word(), f"n{rng.randrange(99)}"])
            lines.append(" ".join(line))
        lines += rng.choice([["menu"], ["home | news | about"], ["1 2 3 4"], [f"{rng.randrange(3)} {rng.randrange(3)} x"], [" ".join(word() for _ in range(6))]])
        rows.append((i, "\n".join(lines)))
    return rows


def test_templates_against_brute_force(docs_of, odd_rows):
    for rows in (ROWS, [r for r in odd_rows if r not in ROWS], families()):
        want = brute([(i, t) for i, t in rows])
        got = drop_recurring_lines(docs_of(rows))
        assert got.columns[-2:] == ["_n_lines", "_n_dropped"] and "n_lines" in got.columns
        found = Counter((r["doc_id"], r["text"], r["_n_dropped"]) for r in got.collect())
        assert found == Counter((r[0], *want[r]) for r in rows)


def test_variable_fields_are_one_template(docs_of):
    got = {r["doc_id"]: r["text"] for r in drop_recurring_lines(docs_of(ROWS)).collect() if r["doc_id"] in (1, 2, 3, 4)}
    assert LOG.format("ann", "h1", 3) in got[1]
    assert got[2] == "another line that no other document has got"  # short lines recur too
    assert got[3] == "before\nafter" and got[4] == ROWS[3][1]


def test_both_ways_to_pick_lines_agree_and_empty(docs_of):
    docs = docs_of(ROWS)
    few, many = (sorted(map(str, drop_recurring_lines(docs, broadcast_rows=n).collect())) for n in (0, 1000))
    assert few == many
    assert drop_recurring_lines(docs.limit(0)).collect() == []


def test_long_text_with_many_dropped_lines(docs_of):
    lines = [f"line with a word of its own {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} and more" for i in range(3000)]
    got = {r["doc_id"]: r["text"] for r in drop_recurring_lines(docs_of([(1, "\n".join(lines)), (2, "\n".join(["start", *lines, "end"]))])).collect()}
    assert hashlib.md5(got[1].encode()).digest() == hashlib.md5("\n".join(lines).encode()).digest()
    assert got[2] == "start\nend"


def test_indented_lines_are_alike(docs_of):
    line = "this line of ten words stands in all three documents"
    rows = [(1, line), (2, f"  {line}\nown"), (3, f"mine\n\t{line} \r")]
    got = {r["doc_id"]: r["text"] for r in drop_recurring_lines(docs_of(rows)).collect()}
    assert got == {1: line, 2: "own", 3: "mine"} == {i: t for (i, _), (t, _) in brute(rows).items()}


def test_second_family_of_a_leaf_is_one_template(docs_of):
    """Two families with the same words in front, each line with a name of its own."""
    names = ["ann", "bob", "eve", "dan", "kim", "lee"]
    first, second = "it was said that {} had opened the old door of this house again", "it was said then {} never could find any reason why she left us"
    rows = [(i, (first if i % 2 else second).format(n) + f"\nkept {n}") for i, n in enumerate(names + names[::-1])]
    got = {r["doc_id"]: r["text"].split("\n")[0][:15] for r in drop_recurring_lines(docs_of(rows)).collect()}
    assert sum(t.startswith("it was") for t in got.values()) == 2


def test_shared_blocks_of_long_lines_cost_no_squares(spark, docs_of):
    """Four lines that share all but one word: the rows made of them grow as their words."""
    made = {}
    for n in (200, 2_000):
        words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(n)]
        base = [" ".join([*words[:-1], end]) for end in ("one", "two", "six", "ten")]
        hot = [" ".join(["waaa", *words[1:3], *(w + "x" for w in words[3:])])] * 9
        got = drop_recurring_lines(docs_of(list(enumerate(hot + base)))).collect()
        made[n] = sum(r["text"] != "" for r in got)
    assert made == {200: 2, 2_000: 2}


def test_query_of_a_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = {d[0]: (text or "", n) for d, (text, n) in brute(rows).items()}
    for r in op5_line_templates(spark, "/root/testdata/sf0.001").collect():
        assert (r["text_sha256"], r["n_dropped"]) == (hashlib.sha256(want[r["doc_id"]][0].encode()).hexdigest(), want[r["doc_id"]][1])
