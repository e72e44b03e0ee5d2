"""What the operators once left undone: several passages in one pair, rows that share an id."""

import re

import numpy as np

from halfhourly.llm import chaining, pii, winnow


def _words(rng, n):
    return [f"w{i}" for i in rng.integers(0, 10**9, n)]


def test_passages_parted_by_foreign_words(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for k, (size, gap) in enumerate([(60, 26), (60, 30), (60, 50), (250, 30), (60, 200), (200, 150), (200, 300), (80, 100)]):
        parts = [_words(rng, size) for _ in range(3)]
        for doc in (2 * k, 2 * k + 1):
            text, want[doc] = _words(rng, 45), []
            for p in parts:
                want[doc].append((len(text), len(text) + size))
                text += p + _words(rng, gap)
            rows.append((doc, " ".join(text)))
    got = {r.doc_id: [(p.start, p.stop) for p in r.passages] for r in
           chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_passages_of_several_partners(spark):
    """A smaller id holds a part of the copy only; or each line of the copy is first seen, and last, elsewhere."""
    rng = np.random.default_rng(9)
    rows, want = [], {}

    def add(doc, words):
        head = _words(rng, 30)
        rows.append((doc, " ".join(head + words + _words(rng, 30))))
        return len(head)
    shared = _words(rng, 60)
    add(0, shared[:45])
    for doc in (1, 2):
        at = add(doc, shared)
        want[doc] = (at, at + 60)
    lines = [_words(rng, 20) for _ in range(4)]
    for k, line in enumerate(lines):
        add(10 + k, line)
        add(90 + k, line)
    for doc in (20, 21):
        at = add(doc, sum(lines, []))
        want[doc] = (at, at + 80)
    got = {r.doc_id: [(p.start, p.stop) for p in r.passages] for r in
           chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: p for d, p in got.items() if p} == {d: [p] for d, p in want.items()}


def test_passages_cover_partly_overlapping_copies(spark):
    """Documents made of random cuts of a few sources: every run of 68 words (50 and the 9 at either end that a seed may
    not reach) that another document holds is inside a passage, and every passage is covered by shared words."""
    rng = np.random.default_rng(10)
    sources = [_words(rng, 300) for _ in range(6)]
    docs = {}
    for doc in range(40):
        words = []
        for _ in range(4):
            src, size = sources[rng.integers(6)], int(rng.integers(15, 140))
            at = int(rng.integers(0, 300 - size))
            words += src[at:at + size] + _words(rng, int(rng.integers(10, 60)))
        docs[doc] = words

    def covered(length):
        seen = {}
        for doc, w in docs.items():
            for k in range(len(w) - length + 1):
                seen.setdefault(tuple(w[k:k + length]), set()).add(doc)
        return {doc: {k + j for k in range(len(w) - length + 1) if len(seen[tuple(w[k:k + length])]) > 1 for j in range(length)}
                for doc, w in docs.items()}
    must, may = covered(68), covered(1)
    rows = chaining.passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")).collect()
    for r in rows:
        got = {k for p in r.passages for k in range(p.start, p.stop)}
        # at either end of a run, up to nine words beyond its outer seeds can belong to another partner
        inner = {k for k in must[r.doc_id] if all(k + j in must[r.doc_id] for j in range(-9, 10))}
        assert inner <= got
        assert len(got & may[r.doc_id]) >= chaining.IDENTITY * len(got)


def test_clean_rows_stay_beside_dirty_ones_of_their_id(spark):
    item = "rain falls on quiet hills and rivers run down to the sea"
    docs = spark.createDataFrame([(None, f"so {item} it is"), (None, "clean one"), (None, None), (1, f"so {item} it is"),
                                  (1, "clean two"), (2, "clean three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.text or "" for r in winnow.keep_clean(docs, bench).collect()) == ["", "clean one", "clean three", "clean two"]

def test_identifiers_after_identifiers_are_found(spark):
    rows = [(i, f"room {i} call +1 555 200 30{i:02d} now") for i in range(6)]
    rows += [(10 + i, f"bob@x.org or +1 555 200 40{i:02d} now") for i in range(6)]
    rows += [(50, "room 12 call 555-0199 now"), (51, "bob@x.org or 555-0199"), (52, "bob@x.org or 555-0199, room 7 call 555-0200")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "phone:13:21" and got[51] == "email:0:9,phone:13:21"
    assert got[52] == "email:0:9,phone:13:21,phone:35:43"


def test_contexts_are_the_text_before_the_span(spark):
    rng = np.random.default_rng(11)
    parts = ["1", "22", "a", "word", "555-0199", "x@y.org", "1.2.3.4", "+1 555 200 3000", "4111111111111111", "caf\xe9 \U0001f600", "b7" * 40 + "x"]
    texts = [" ".join(rng.choice(parts, int(rng.integers(1, 120)))) for _ in range(60)]
    rows = pii.base(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "near").collect()
    seen = 0
    for r in rows:
        t = texts[r.doc_id]
        for u in r.near:
            two = re.search(r"(\S+)\s+(\S+)\s*$", t[max(0, u.s - pii.CONTEXT):u.s])
            assert t[u.s:u.e] == u.token and u.ctx == " ".join(re.sub("[0-9]+", "0", two[0].lower()).split())
            seen += 1
        starts = {u.s for u in r.near}
        for m in re.finditer(r"(?<!\S)b7\S+", t):
            assert m.start() in starts or not re.search(r"\S+\s+\S+\s*$", t[max(0, m.start() - pii.CONTEXT):m.start()])
    assert seen > 500


def test_passages_whose_seeds_stand_in_many_documents(spark):
    """A copy with changed words is found as it is without them, whatever other documents hold its lines: of smaller ids, of
    larger ones, or many."""
    rng = np.random.default_rng(12)
    rows, copies = [], {}

    def add(doc, words):
        rows.append((doc, " ".join(_words(rng, 30) + words + _words(rng, 30))))
    for k, others in enumerate([1, 1, 6, 6]):
        shared = _words(rng, 120)
        for r in range(others):
            for j in range(0, 120, 12):  # each line first and last seen elsewhere
                add(1000 * k + 10 * r + j // 12, shared[j:j + 12])
                add(1000 * k + 900 - 10 * r - j // 12, shared[j:j + 12])
        edited = list(shared)
        for j in range(6, 120, 12):
            edited[j] = f"changed{k}x{j}"
        for doc, words in ((1000 * k + 500, shared), (1000 * k + 501, edited)):
            add(doc, words)
            copies[doc] = set(range(30, 150))

    def found(rows):
        return {r.doc_id: {w for p in r.passages for w in range(p.start, p.stop)} for r in
                chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    got, alone = found(rows), found([r for r in rows if r[0] in copies])
    for doc, want in copies.items():
        assert len(alone[doc]) >= 100 and alone[doc] <= got[doc] <= want
    assert not any(words for doc, words in got.items() if doc not in copies)


def test_passages_reach_the_ends_of_what_any_document_shares(spark):
    """Exact copies of 50 words, their first and last words also in documents of smaller and of larger ids."""
    rng = np.random.default_rng(13)
    rows, want = [], {}
    for k in range(20):
        shared, size = _words(rng, 50), int(rng.integers(8, 25))
        for doc in (100 * k + 50, 100 * k + 51):
            head = _words(rng, 20)
            rows.append((doc, " ".join(head + shared + _words(rng, 20))))
            want[doc] = [(20, 70)]
        for doc in (100 * k, 100 * k + 99):
            rows.append((doc, " ".join(_words(rng, 20) + shared[2:size] + _words(rng, 20) + shared[-size:-2] + _words(rng, 20))))
            want[doc] = []
    got = {r.doc_id: [(p.start, p.stop) for p in r.passages] for r in
           chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_repeated_lines_are_aligned_once_not_match_by_match(spark, monkeypatch):
    """Two documents of one line over and over, parted by foreign words: every word of the lines is covered, by spans that do
    not grow with the number of their matches."""
    rng = np.random.default_rng(14)
    line, sizes, rows, want = _words(rng, 9), {}, [], {}
    for doc, counts in ((1, [30, 25, 40]), (2, [28, 45])):
        text, want[doc] = _words(rng, 20), set()
        for n in counts:
            want[doc] |= set(range(len(text), len(text) + 9 * n))
            text += line * n + _words(rng, 60)
        rows.append((doc, " ".join(text)))

    def counted(df, name, materialize=chaining.materialize):
        out = materialize(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(chaining, "materialize", counted)
    for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert {k for p in r.passages for k in range(p.start, p.stop)} >= want[r.doc_id]
    assert sizes["aligned"] < 20 * sizes["candidates"]
