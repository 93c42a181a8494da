"""Items with edits in texts, against the plain edit-distance table."""

import random

import numpy as np

from chainlytics.llm import leaks as L

WORDS = ["the", "of", "and", "ention", "ther", "thing", "stan", "éeau", "Ünd", "to", "in"]


def plain(pattern, text):
    last, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for j, c in enumerate(text, 1):
        now = [0]
        for i, x in enumerate(pattern, 1):
            now.append(min(last[i] + 1, now[i - 1] + 1, last[i - 1] + (x != c)))
        last = now
        if last[-1] < best[0]:
            best = (last[-1], j)
    return best


def normalised(text):
    raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
    return L.normal(raw, np.array([0, len(raw)]))[0].tobytes()


def case(seed):
    rng = random.Random(seed)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    def edited(text, times):
        own = list(text)
        for _ in range(times):
            at = rng.randrange(len(own))
            kind = rng.randint(0, 2)
            own[at : at + (kind > 0)] = [] if kind == 1 else ["q"]
        return "".join(own)

    items = [(n, prose(rng.randint(4, 30))) for n in range(10)] + [(3, prose(9)), (90, None), (91, "ab"), (92, ""), (None, prose(12))]
    docs = []
    for n in range(80):
        text = prose(rng.randint(0, 60))
        if rng.random() < 0.7:
            item = rng.choice(items[:11])[1]
            text += "\n  " + edited(item, rng.randint(0, 12)).replace(" ", rng.choice([" ", "\n", " \t "])).upper() + "  " + prose(rng.randint(0, 30))
        docs.append((n, text))
    return items, docs + [(500, None), (501, ""), (None, items[3][1]), (2, docs[2][1]), (502, prose(20_000) + max((t or "" for _, t in items[:3]), key=len))]


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(150):
        pattern = bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 90)))
        text = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.5:
            text = text[:20] + pattern[: len(pattern) // 2] + pattern[len(pattern) // 2 + 1 :] + text[20:]
        assert L.myers(pattern, text) == plain(pattern, text)


def expected(items, docs):
    out = []
    for item, text in items:
        pattern = normalised(text).strip()
        if len(pattern) < L.LEAST:
            continue
        for doc, body in docs:
            if len(body or "") > 50_000:
                found = 0 if pattern in normalised(body) else None
            else:
                found = plain(pattern, normalised(body))[0]
            if found is not None and found <= len(pattern) * L.RATE // 100:
                out.append((doc, item, found))
    return sorted(out, key=str)


def test_all_items_and_no_others(spark):
    for seed in (1, 2):
        items, docs = case(seed)
        frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, distance int").repartition(3)
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        got = L.matches(frame, bench).collect()
        want = expected(items, docs)
        short = [w for w in want if w[0] != 502]
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in got if r.doc_id != 502), key=str) == short and len(short) > 20
        longest = max(items[:3], key=lambda i: len(i[1]))[0]
        assert (502, longest, 0) in {(r.doc_id, r.item_id, r.distance) for r in got}
        by_doc = dict(docs)
        for r in got:
            if r.doc_id is not None and r.distance == 0:
                own = by_doc[r.doc_id].encode("utf-8")[r.start : r.end].decode("utf-8")
                assert normalised(own) in {normalised(t).strip() for i, t in items if i == r.item_id}
        dirty = {(r.doc_id) for r in got}
        kept = [r.doc_id for r in L.clean(frame, bench).collect()]
        assert sorted(map(str, kept)) == sorted(str(d) for d, _ in docs if d not in dirty)


def test_short_items_are_found(spark):
    items = [(1, "Is it so?"), (2, "2 + 2 = 4"), (3, "ab"), (4, "What is pi?"), (5, "Name two gases."), (6, "a"), (7, " "), (8, "?!"), (9, "été")]
    docs = [(1, "He asked: is\nit  SO? No."), (2, "so 2 + 2 = 4"), (3, "2 + 2 = 42 and 12 + 2 = 4"), (4, "about abs, cab"), (5, "cab about; x (AB)"), (6, "what iz pi?"), (7, "wat iz pi?"), (8, "Name two gasses."), (9, "gases, two"), (10, "ab"), (11, "word?! next"), (12, "étés"), (13, "cet été"), (14, ""), (15, None), (16, "ab" * 500 + " ab")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.distance) for r in L.matches(frame, bench).collect())
    assert got == [(1, 1, 0), (2, 2, 0), (5, 3, 0), (6, 4, 1), (8, 5, 1), (10, 3, 0), (11, 8, 0), (13, 9, 0), (16, 3, 0)]
    by_id = dict(docs)
    own = {(r.doc_id, r.item_id): by_id[r.doc_id].encode()[r.start : r.end].decode() for r in L.matches(frame, bench).collect() if r.distance == 0}
    assert own[1, 1] == "is\nit  SO?" and own[5, 3] == "AB" and own[13, 9] == "été"
    assert sorted(r.doc_id for r in L.clean(frame, bench).collect()) == [3, 4, 7, 9, 12, 14, 15]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "an item of some length here")], "item_id bigint, text string")
    assert L.matches(docs.limit(0), items).count() == 0 and L.matches(docs, items.limit(0)).count() == 0
    assert L.clean(docs, items.limit(0)).count() == 1 and L.clean(docs.limit(0), items).count() == 0
