import random

from nameledger.llm.chat import format_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n int, at string, rendered int"


def plain(data):
    order = lambda x: tuple((v is not None, v) for v in x)
    talks, loose = {}, []
    for conv, turn, role, text, *_ in data:
        row = (turn, role if role is not None else "unknown", text or "")
        (loose.append((None, [row])) if conv is None else talks.setdefault(conv, []).append(row))
    talks = [(c, sorted(t, key=order)) for c, t in talks.items()] + loose
    talks = [(c, tuple(x[1:] for x in t)) for c, t in talks]
    longer = {t[:i] for _, t in talks for i in range(1, len(t))}
    groups = {}
    for conv, t in talks:
        groups.setdefault(t, []).append(conv)
    out = []
    for t, convs in groups.items():
        if t not in longer:
            ids = [c for c in convs if c is not None]
            text = "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in t)
            out.append((min(ids) if ids else None, len(t), len(convs), text))
    return sorted(out, key=repr)


def test_maximal_conversations(rows):
    draw = random.Random(9)
    data = []
    stories = [[(draw.choice(["user", "assistant"]), f"t{draw.randrange(30)}") for _ in range(draw.randint(1, 7))] for _ in range(12)]
    for conv in range(150):
        story = draw.choice(stories)
        for turn, (role, text) in enumerate(story[: draw.randint(1, len(story))]):
            data.append((conv, turn, role, text, 0, "", 0))
    first = stories[0][0]
    data += [(None, 0, *first, 0, "", 0), (None, 5, "user", "alone", 0, "", 0), (None, 6, "user", "alone", 0, "", 0)]
    data += [(500, None, None, None, 0, "", 0), (500, 1, "user", "x", 0, "", 0), (501, 1, "user", "x", 0, "", 0), (501, 1, "user", "x", 0, "", 0), (502, 3, "", "", 0, "", 0)]
    data += [(600, i, "user", "go on " * 2000, 0, "", 0) for i in range(60)]
    draw.shuffle(data)
    got = format_conversations(rows(data, SCHEMA))
    assert got.columns == ["conv_id", "n_turns", "n_copies", "rendered"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(data)


def test_no_conversations(rows):
    assert format_conversations(rows([], SCHEMA)).count() == 0
