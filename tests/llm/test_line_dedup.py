"""Line dedup: exact, digit and field templates, first document, copies, odd rows."""

import collections
import random
import re

from tidemark.llm import line_dedup as L

from helpers import documents, letters, odd_documents


def cleaned(docs, **options):
    return {r["doc_id"]: r["text"] for r in L.dedup_lines(docs, **options).collect()}


def own(i, n=12):
    return letters(1000 + i, n)


def test_templates_recur_across_documents(spark):
    passage = letters(1, 60)
    texts = {
        1: f"{own(1)}\n{passage}\n{own(2)}",
        2: f"{passage}\n{own(3)}",                                            # the passage is kept in document 1
        3: f"{own(4)}\npage 3 of 17 pages\n{passage}",
        4: f"page  4 of 9 pages\n\n{own(5)}",                                  # digits are variable
        5: f"user alice logged in from paris at noon yesterday again\n{own(6)}",
        6: f"user alice logged in from rome at noon yesterday again\n{own(7)}",    # 9 of 10 fields agree
        7: f"user alice logged in with quite another story than before\n{own(8)}",  # 4 of 10 do
        8: f"{own(9)}\n{own(9)}\n{own(10)}",                                     # repeats in one document alone stay
        9: "Yes.\nYes indeed.\n}\n12\n\n" + own(11),
        10: "Yes.\nYes indeed.\n}\n13\n\n" + own(12),                         # short lines recur as they are, if they have letters
    }
    got = cleaned(documents(spark, list(texts.values()), list(texts)))
    want = texts | {2: own(3), 3: f"{own(4)}\npage 3 of 17 pages", 4: f"\n{own(5)}", 6: own(7), 10: "}\n13\n\n" + own(12)}
    assert got == want


def test_a_leaf_holds_several_templates(spark):
    a, b = (f"the old man {letters(20 + k, 17)}" for k in range(2))
    other = b.replace(b.split()[-2], "elsewhere")
    texts = [f"{a}\n{own(0)}", f"{own(1)}\n{a}", f"{own(2)}\n{a}\n{own(3)}", f"{b}\n{own(4)}", f"{own(5)}\n{other}"]
    assert cleaned(documents(spark, texts)) == {0: texts[0], 1: own(1), 2: f"{own(2)}\n{own(3)}", 3: texts[3], 4: own(5)}


def test_crowded_leaves_vote_in_their_children(spark):
    heads = [f"the old man {letters(40 + k, 3)}" for k in range(12)]     # one leaf, twelve nodes below it
    pairs = [(f"{h} {letters(60 + k, 14)} yes", f"{h} {letters(60 + k, 14)} no") for k, h in enumerate(heads)]
    texts = ["\n".join(p[0] for p in pairs), "\n".join(p[1] for p in pairs)]
    got = cleaned(documents(spark, texts))
    assert got == {0: texts[0], 1: ""}


def test_lines_without_spaces(spark):
    chinese, thai = "今天天气很好我们一起去公园散步然后回家吃饭看书写字睡觉吧", "สวัสดีครับวันนี้อากาศดีมากเราไปเดินเล่นกัน"
    near = chinese.replace("书", "报")
    spaced = letters(7, 9).replace(" ", "\u3000")
    texts = [f"{chinese}\n{own(1)}\n{thai}\n{spaced}", f"{own(2)}\n{near}\n{thai}", f"{chinese[:9]}\n{own(3)}\n" + spaced.replace("\u3000", "\u00a0 ")]
    assert cleaned(documents(spark, texts)) == {0: texts[0], 1: own(2), 2: f"{chinese[:9]}\n{own(3)}"}


def by_hand(texts, similar=0.8):
    """The operator in plain Python: {id: text}."""
    def fields(line):
        line = re.sub(r"[\x85\u00a0\u3000]", " ", line)
        line = re.sub(r"[\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e3a]", r" \g<0> ", line)
        return ["<*>" if re.search("[0-9]", w) else w for w in re.split(r"[ \t\x0b\f\r]+", line.strip(" \t\x0b\f\r"))]
    seen = collections.defaultdict(list)  # line -> documents, repeats included
    for i, text in texts.items():
        for line in text.split("\n"):
            f = tuple(fields(line))
            if len(f) >= 3 or any(c.isalpha() for c in "".join(f)):
                seen[f].append(i)
    rest, template = set(seen), {}
    for vote, lead in enumerate(L.LEADS):
        nodes = collections.defaultdict(list)
        for f in rest:
            nodes[len(f), f[:lead]].append(f)
        rest = set()
        for key, lines in nodes.items():
            if len(lines) == 1 or len({i for f in lines for i in seen[f]}) == 1:
                continue
            usual = [max(collections.Counter({w: sum(len(seen[f]) for f in lines if f[p] == w) for w in {f[p] for f in lines}}).items(),
                         key=lambda x: (x[1], x[0]))[0] for p in range(key[0])]
            for f in lines:
                if sum(a == b for a, b in zip(f, usual)) >= similar * len(f):
                    template[f] = (vote, key)
                else:
                    rest.add(f)
    first = {}
    for f, docs in seen.items():
        t = template.get(f, f)
        first[t] = min([first.get(t, docs[0]), *docs])
    return {i: "\n".join(line for line in text.split("\n")
                         if tuple(fields(line)) not in seen or first[template.get(tuple(fields(line)), tuple(fields(line)))] == i) for i, text in texts.items()}


def test_equals_the_operator_by_hand(spark):
    r = random.Random(5)
    def line():
        n = r.choice([1, 2, 3, 5, 8, 12])
        return " ".join(r.choice(["a", "b", "the", "x1", "中", "了"] if k < 6 else ["a", "b"]) for k in range(n))
    texts = {i: "\n".join(line() for _ in range(r.randrange(1, 9))) for i in range(80)}
    assert cleaned(documents(spark, list(texts.values()))) == by_hand(texts)


def test_each_template_survives_once(spark):
    passage = letters(2, 55)
    texts = [f"{own(2 * i)}\n{passage}\n{own(2 * i + 1)}" for i in range(40)]
    got = cleaned(documents(spark, texts).repartition(7))
    assert [i for i, t in got.items() if passage in t] == [0]
    assert all(own(2 * i) in t and own(2 * i + 1) in t for i, t in got.items())


def test_copies_can_be_left_whole(spark):
    passage = letters(3, 50)
    copy = "\n".join(own(100 + k) for k in range(10))
    texts = [copy, copy, f"{passage}\n{own(200, 80)}", f"{own(201, 80)}\n{passage}"]
    docs = documents(spark, texts)
    assert cleaned(docs) == {0: copy, 1: "", 2: texts[2], 3: own(201, 80)}
    assert cleaned(docs, copy_share=0.8) == {0: copy, 1: copy, 2: texts[2], 3: own(201, 80)}


def test_only_shown_copies_are_left_whole(spark):
    a, b, c = (letters(10 + k, 60) for k in range(3))
    copy = [own(300 + k, 30) for k in range(10)]
    near = "\n".join([*copy[:9], own(320, 6)])
    texts = [f"{a}\n{own(1, 80)}", f"{b}\n{own(2, 80)}", f"{a}\n{own(3)}\n{b}",      # passages of two documents: no copy of any one
             "\n".join([c, *copy]), "\n".join([c, near]),                           # a near copy
             "\n".join(copy[:3]),                                                   # an excerpt: no near copy of the whole
             f"{c}\n{a}", f"{a}\n{c}"]                                              # copies of each other, of other documents' lines
    got = cleaned(documents(spark, texts), copy_share=0.8)
    assert got == dict(enumerate(texts)) | {2: own(3), 5: "", 6: "", 7: ""}
    # A copy loses what its original loses, so that both still meet in the join.
    texts = [f"{a}\n{own(1, 80)}", "\n".join([a, *copy]), "\n".join([a, *copy])]
    assert cleaned(documents(spark, texts), copy_share=0.8) == {0: texts[0], 1: "\n".join(copy), 2: "\n".join(copy)}


def test_counts_and_odd_rows(spark):
    odd = odd_documents(spark).where("doc_id IS NOT NULL")
    out = L.dedup_lines(odd)
    assert out.columns == [*odd.columns, "_n_lines_", "_n_dropped_"]  # the table has columns of the plain names
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(map(str, (r["text"] for r in odd.collect())))
    # Rows that share an id are one document; documents without an id are told apart by their texts.
    line = letters(4, 20)
    docs = documents(spark, [line, line, f"{line}\n{own(1)}", f"{line}\n{own(2)}"], [5, 5, None, None])
    rows = L.dedup_lines(docs).collect()
    assert sum(line in r["text"].split("\n") for r in rows) in (1, 2)  # kept in one document: the two rows of id 5, or one of the others
    empty = L.dedup_lines(documents(spark, []))
    assert empty.count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.dedup_lines(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
