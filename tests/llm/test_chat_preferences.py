from tabloom.llm import chat_preferences as c

SCHEMA = "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt_id string"


def brute(chosen, rejected):
    left, right = ([(r or "", t or "") for r, t in (x or [])] for x in (chosen, rejected))
    n = 0
    while n < min(len(left), len(right)) and left[n] == right[n]:
        n += 1
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)

    def spans(turns):
        at, found = 0, []
        for role, text in turns:
            begin = at + len(f"<|{role}|>\n")
            at = begin + len(text) + len("<|end|>\n")
            if role == "assistant":
                found.append((begin, at))
        return found

    return show(left[:n]), n, show(left[n:]), spans(left[n:]), show(right[n:]), spans(right[n:])


PAIRS = [
    ([("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "b")]),
    ([("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "a")]),
    ([("user", "hi")], [("user", "hi"), ("assistant", "é🙂"), ("user", "x"), ("assistant", "")]),
    ([("user", "hi")], [("system", "hi")]),
    (None, [("assistant", "b")]),
    ([], []),
    ([(None, None), ("assistant", None)], [("", ""), ("assistant", "y")]),
    ([("user", "q" * 50_000), ("assistant", "z")], [("user", "q" * 50_000)]),
    ([("user", "same")] * 30 + [("assistant", "a")] * 3, [("user", "same")] * 30 + [("assistant", "c")]),
]


def test_pairs_against_brute_force(spark):
    df = spark.createDataFrame([(i, a, b, "p") for i, (a, b) in enumerate(PAIRS)], SCHEMA)
    got = c.format_preferences(df)
    assert got.columns[:2] == ["id", "prompt_id"]
    for r in got.collect():
        spans = lambda x: [(s.start, s.end) for s in x]
        found = (r.prompt, r.prompt_turns, r.chosen, spans(r.chosen_spans), r.rejected, spans(r.rejected_spans))
        assert found == brute(*PAIRS[r.id])


def test_answers_of_neighbours(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"),
        (1, 1, "assistant", "a1"), (1, 0, "user", "q1"), (1, 0, "system", "s"),
        (2, 0, "user", "q2"), (2, 1, "assistant", "a2"),
        (4, 0, "user", "q4"), (5, 0, "assistant", "a5"),
        (6, None, None, None), (None, 3, "user", "lost"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    plain = lambda turns: None if turns is None else [tuple(t) for t in turns]
    got = {r.conv_id: (plain(r.chosen), plain(r.rejected)) for r in c.paired_answers(df).collect()}
    q0, s, q1 = ("user", "q0"), ("system", "s"), ("user", "q1")
    assert got[0] == ([q0, ("assistant", "a0")], [q0, ("assistant", "a1")])
    assert got[1] == ([s, q1, ("assistant", "a1")], [s, q1, ("assistant", "a0")])
    assert got[2] == ([("user", "q2"), ("assistant", "a2")], None)
    assert got[4] == ([("user", "q4")], None)
    assert got[5] == ([("assistant", "a5")], None)
    assert got[6] == ([("", "")], None)
    assert c.format_preferences(c.paired_answers(df)).count() == len(got)
    assert c.paired_answers(df.where("false")).count() == 0
