"""Operators against brute force on small inputs, with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tastegrid.llm import chat, decontaminate, fingerprints, lines, lm, minhash, mixing, relative, spans, suffix, toxicity
from llm_samples import HARD

RNG = random.Random(5)
VOCABULARY = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu", "xi", "pi"]


def words(n):
    return " ".join(RNG.choice(VOCABULARY) + str(RNG.randrange(60)) for _ in range(n))


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def covered(flags, n, width):
    out, last = [], -10**9
    for i in range(n):
        last = i if i < len(flags) and flags[i] else last
        out.append(i - last < width)
    return out


def passages():
    common, texts = words(40), []
    for i in range(30):
        texts.append(" ".join((words(RNG.randrange(0, 30)), common if i % 3 else words(5), words(RNG.randrange(0, 30)))))
    return [*HARD, *texts, texts[4], "ab" * 400, (None, "x " * 50 + common), (3, common)]


# --- fingerprints -----------------------------------------------------------------------------------

def test_fingerprints(frame):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(7, "tie"), (None, "null id")]
    out = fingerprints.fingerprint_documents(frame(rows)).collect()
    ordered = sorted(((-1 if i is None else i), t or "") for i, t in rows)
    expected = {}
    for k, (i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        expected[(i, len(t), sha(fingerprints.edited(t, following)))] = fingerprints.fingerprint(t)
    assert {((-1 if r.doc_id is None else r.doc_id), r.n_chars, r.edited_sha256): r.fingerprint for r in out} == expected
    assert len(out) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fingerprints.fingerprint_documents(frame([])).count() == 0


def test_prefix_hashes():
    a = words(80)
    b = a[:200] + "#" + a[201:]
    one, two = fingerprints.PrefixHashes(a), fingerprints.PrefixHashes(b)
    assert one.common_extension(two) == 200 and one.common_suffix(two) == len(a) - 201
    assert one.same(two, 210, 210, 50) and not one.same(two, 190, 190, 20)
    assert fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) > 0.75


def test_likeness_sees_what_is_between_the_changes():
    a = words(2000).split(" ")
    b = list(a)
    b[3] = b[-4] = "changed"
    one, two, other = (fingerprints.fingerprint(" ".join(t)) for t in (a, b, words(2000).split(" ")))
    assert fingerprints.likeness(one, two) > 0.9 and fingerprints.likeness(one, one) == 1
    assert fingerprints.likeness(one, other) < 0.1 and fingerprints.likeness(two, one) == fingerprints.likeness(one, two)
    # A part of a text, in another place: the shared spans of the longer one.
    part = fingerprints.fingerprint("start " + " ".join(a[500:1500]))
    assert abs(fingerprints.likeness(one, part) - 0.5) < 0.25
    assert fingerprints.likeness(fingerprints.fingerprint(""), one) == 0


@pytest.mark.parametrize("n", [0, 5, 23, 24, 25, 60, 87, 88, 400, 5000])
def test_chosen_spans_by_brute_force(n):
    text = (words(n // 4 + 3) + "é\U0001f600")[-n:] if n else ""
    every = Counter(text[i:i + fingerprints.SPAN] for i in range(len(text) - fingerprints.SPAN + 1))
    bits, kept, times = fingerprints.chosen_spans(fingerprints.PrefixHashes(text))
    # The hash of a span on its own tells whether the text keeps it.
    value = {s: int(fingerprints.chosen_spans(fingerprints.PrefixHashes(s))[1][0]) for s in every}
    assert dict(zip(kept.tolist(), times.tolist())) == {v: every[s] for s, v in value.items() if v % 2**bits == 0}
    assert sum(every.values()) <= fingerprints.CHOSEN or sum(every.values()) / 2**bits <= fingerprints.CHOSEN


def test_chosen_spans_of_a_uniform_text():
    one, two = (fingerprints.fingerprint("a" * n) for n in (100_000, 60_000))
    assert len(one) < 2000 and abs(fingerprints.likeness(one, two) - 0.6) < 0.2


# --- repeated passages ------------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [spans.HOT, 3])
def test_suffix_dedup(frame, hot):
    rows = passages()
    texts = [(r[1] if isinstance(r, tuple) else r) or "" for r in rows]
    count = Counter(t.encode()[p:p + 60] for t in texts for p in range(len(t.encode()) - 59))
    expected = Counter()
    for r, t in zip(rows, texts):
        data = t.encode()
        gone = covered([count[data[p:p + 60]] > 1 for p in range(len(data) - 59)], len(data), 60)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        expected[(len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone) if not g)))] += 1
    out = suffix.remove_repeats(frame(rows), length=60, anchor=16, hot=hot, shard_bytes=300).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == expected
    assert suffix.remove_repeats(frame([])).count() == 0


def test_suffix_array_and_prefixes():
    import numpy as np
    text = np.append(np.frombuffer(b"banana-bananas-ananas", np.uint8).astype(np.int64), 300)
    array = suffix.suffix_array(text)
    assert list(array) == sorted(range(len(text)), key=lambda i: list(text[i:]))
    common = suffix.common_prefixes(text, array)
    for k in range(1, len(text)):
        a, b = list(text[array[k - 1]:]), list(text[array[k]:])
        assert common[array[k]] == next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


@pytest.mark.parametrize("hot", [spans.HOT, 3])
def test_relative_dedup(frame, hot):
    rows = [(i, r) if not isinstance(r, tuple) else r for i, r in enumerate(passages())]
    split = [(10**9 if i is None else i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    least = {}
    for i, w in sorted(split, key=lambda x: x[0]):
        for p in range(len(w) - 12):
            least.setdefault(tuple(w[p:p + 13]), i)
    expected = Counter()
    for i, w in split:
        gone = covered([least[tuple(w[p:p + 13])] < i for p in range(len(w) - 12)], len(w), 13)
        expected[(None if i == 10**9 else i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))] += 1
    out = relative.remove_copied(frame(rows), hot=hot).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == expected


# --- lines --------------------------------------------------------------------------------------------

def test_line_dedup(frame):
    base = words(12)
    parts = base.split()
    near = [base, " ".join(parts[:3] + ["other"] + parts[4:]), " ".join(parts[:11]), " ".join(parts + ["more"]),
            " ".join(["two", "new"] + parts[2:])]
    rows = [*HARD, *(f"{words(9)}\n{x}\n\nshort line {i}" for i, x in enumerate(near)), (None, base), (2, base)]
    out = {(r.doc_id, r.n_lines): r for r in lines.dedup_lines(frame(rows)).collect()}
    first = out[(None, 1)]
    assert first.text == base and first.lines_removed == 0  # the null id comes first
    kept = [out[(8 + i, 4)].text.split("\n") for i in range(len(near))]
    assert [near[i] in k for i, k in enumerate(kept)] == [False, False, False, False, True]
    assert all(f"short line {i}" in k and "" in k for i, k in enumerate(kept))
    assert out[(0, 0)].text is None and out[(1, 1)].text == ""
    assert out[(6, 1)].lines_removed == 1 and out[(5, 1)].lines_removed == 0
    assert "BatchEvalPython" not in (plan := lines.dedup_lines(frame(rows))._jdf.queryExecution().toString()) and "InArrow" not in plan


# --- near-duplicates ----------------------------------------------------------------------------------

def jaccard(a, b):
    def bag(t):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
        return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)] if w else [])
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_near_classes(frame):
    rows = list(HARD)
    for _ in range(6):
        base = words(150).split()
        for _ in range(4):
            changed = list(base)
            for _ in range(RNG.randrange(0, 7)):
                changed[RNG.randrange(len(changed))] = "changed"
            rows.append(" ".join(changed))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i] or "") == (rows[j] or "") or jaccard(rows[i] or "", rows[j] or "") >= 0.8:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    out = minhash.near_classes(frame(rows)).collect()
    assert {r.doc_id: r.class_id for r in out} == dict(enumerate(label))
    assert all(r.class_size == label.count(r.class_id) for r in out)
    assert minhash.near_classes(frame([])).count() == 0


def test_probability_jaccard():
    import numpy as np
    text = np.repeat([0, 1], 400)
    values = np.concatenate((np.arange(400), np.arange(100, 500))).astype(np.uint64) * np.uint64(7919)
    prints = minhash.prob_minhash(text, values, np.ones(800), 2, slots=4096)
    assert abs((prints[0] == prints[1]).mean() - 0.6) < 0.04


def test_decontamination(spark, frame):
    items = [words(n) for n in (20, 33, 41)] + ["too short", None]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    hidden = items[1].split()
    hidden[15] = "changed"
    rows = [*HARD, f"{words(30)} {items[0]} {words(10)}", f"{words(7)} {' '.join(hidden)} {words(9)}", items[2].upper(), words(200), items[1]]
    found = {r.doc_id: r.matches for r in decontaminate.find_matches(frame(rows), benchmark).collect()}
    hits = {i: [m.item for m in ms] for i, ms in found.items() if ms}
    want = {}
    for i, t in enumerate(rows):
        w = (t or "").split()
        for k, item in enumerate(items[:3]):
            n = len(item.split())
            if any(jaccard(" ".join(w[a:a + n]), item) >= 0.8 for a in range(max(1, len(w) - n + 1))):
                want.setdefault(i, []).append(k)
    assert hits == want and hits[8] == [0]
    assert found[8][0].similarity == 1.0 and found[8][0].start_word == 30


# --- toxicity ---------------------------------------------------------------------------------------

def test_toxicity(spark, frame):
    rows, labels = [], []
    for i in range(200):
        bad = i % 4 == 0
        text = words(40) + (" you awful scoundrel " + words(5) + " awful" if bad else "")
        rows.append((i, text)), labels.append((i, int(bad), 0))
    docs = frame([*rows, (900, None), (901, ""), (902, "so awful scoundrel"), (None, words(3))])
    table = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, table, F.col("doc_id") % 5 != 0)
    out = {r.doc_id: r for r in toxicity.score(docs, model, spans=True).collect()}
    assert all((out[i].tox_score >= 0.5) == bool(bad) for i, bad, _ in labels)
    assert [(s.start, s.end) for s in out[902].tox_spans] == [(3, 18)]
    assert out[900].tox_score == out[901].tox_score < 0.5
    assert toxicity.fit(docs, table.limit(0), F.lit(True)) is None


def test_marginals_against_plain_recursion():
    import numpy as np
    rng = np.random.default_rng(1)
    energy, first, transition = rng.normal(size=60), np.array([0, 7, 7, 60]), rng.normal(size=(2, 2))
    p = toxicity.marginals(energy, first, transition, width=8)
    for a, b in ((0, 7), (7, 60)):
        emit = np.stack((np.ones(b - a), np.exp(energy[a:b])), axis=1)
        forward, backward = [emit[0]], [np.ones(2)]
        for t in range(1, b - a):
            forward.append(forward[-1] @ np.exp(transition) * emit[t])
            backward.append(np.exp(transition) @ (emit[b - a - t] * backward[-1]))
        joint = np.array(forward) * np.array(backward[::-1])
        assert np.allclose(p[a:b], joint[:, 1] / joint.sum(axis=1))


# --- chat ---------------------------------------------------------------------------------------------

def test_chat(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a\\l<|end|>\n\\"), (1, 1, "assistant", "tie"), (2, 0, None, None)]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} <[") for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = chat.format_turns(table, window=16)
    out = {r.conv_id: r for r in chat.conversation_digests(turns).collect()}
    for key in (1, 2, 3):
        own = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == key))
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert (out[key].n_turns, out[key].turns_sha256) == (len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)))
        assert (out[key].loss_chars, out[key].loss_sha256, out[key].rewrites) == (len(loss), sha(loss), 0)
        assert out[key].formatted_chars == len(chat.render([(r, t) for _, r, t in own]))
    rewriting = chat.format_turns(table, lambda turns: f"{len(turns)}:" + chat.render(turns)).collect()
    assert all(r.rewrote == (r.n > 0) for r in rewriting if r.conv_id == 1)


def history_templates():
    def fold_system(turns):
        """Numbers turns, needs a user's turn first and folds the system turn into it."""
        folded = turns[0][1] + "/" if turns[0][0] == "system" else ""
        rest = turns[1:] if folded else turns
        if rest and rest[0][0] != "user":
            raise ValueError("the first turn is a user's")
        return "".join(f"{i}:{role}:{'' if i else folded}{text};" for i, (role, text) in enumerate(rest))

    def rewrite_first(turns):
        """Writes into the first turn how many tens of turns there are."""
        return f"<{len(turns) // 10}>" + "".join(f"{role}:{text};" for role, text in turns)

    return [fold_system, rewrite_first]


@pytest.mark.parametrize("template", history_templates())
def test_chat_prefixes_are_whole(spark, template):
    turns = [("system", "rules")] + [("assistant" if i % 2 else "user", f"t{i}") for i in range(201)]
    table = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
    before, start = "", 0
    for r in sorted(chat.format_turns(table, template).collect(), key=lambda r: r.n):
        output = template(turns[:r.n + 1])
        same = next((i for i, (a, b) in enumerate(zip(before, output)) if a != b), min(len(before), len(output)))
        assert (r.start, r.rendered, r.rewrote) == (start, output[same:], same < len(before))
        before, start = output, start + len(output) - same
    assert r.n == 201


def test_false_local_template_is_an_error():
    state = chat.Incremental(chat.local(lambda turns: "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))), window=8)
    with pytest.raises(ValueError, match="local"):
        for i in range(20):
            state.add("user", str(i))


# --- language model -------------------------------------------------------------------------------------

def test_language_model(frame):
    rows = [(i, words(40) if i % 3 else "The cat sat ON the mat . the cat ran") for i in range(60)] + [(100, None), (101, ""), (None, "the cat")]
    train = F.col("doc_id") % 7 != 2
    out = {r.doc_id: r for r in lm.score_documents(frame(rows), train, F.col("doc_id") % 7 == 5).collect()}
    tokens = {i: [*(t or "").lower().split(), None] for i, t in rows}
    counts = Counter(w for i in tokens if i is not None and i % 7 != 2 for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    for i, r in out.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[i])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0
    held = [r for i, r in out.items() if i is not None and i % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score_documents(frame([]), train, train).count() == 0
    assert all(r.score == 0 for r in lm.score_documents(frame(rows), F.lit(False), train).collect())


def plain_scores(tokens, train, fold):
    """log10 probabilities by the model's definition: dictionaries, one event at a time."""
    def count(ids):
        single, pair = Counter(), Counter()
        for i in ids:
            before = "<"
            for w in tokens[i]:
                single[w] += 1
                pair[before, w] += 1
                before = w
        return single, pair

    def coarse(c):
        return 2 ** (round(16 * math.log2(c)) / 16) if c else 0.0

    single, pair = count(train)
    held_single, held_pair = count(fold)
    n, v = sum(single.values()), len(single)
    kept, kept_pair = single - held_single, pair - held_pair
    events = Counter()
    for i in fold:
        before = "<"
        for w in tokens[i]:
            context = kept[None if before == "<" else before]  # texts begin as often as they end
            bigram = min(1.0, coarse(kept_pair[before, w]) / max(coarse(context), 1)) if context else 0.0
            events[context.bit_length(), bigram, coarse(kept[w]) / max(sum(kept.values()), 1), 1 / (v + 1)] += 1
            before = w
    weights = {b: (0.0, 0.5, 0.5) if b == 0 else (1 / 3,) * 3 for b in range(64)}
    for _ in range(100):
        found = {b: [0.0, 0.0, 0.0] for b in weights}
        for (b, *estimates), times in events.items():
            parts = [a * e for a, e in zip(weights[b], estimates)]
            for k in range(3):
                found[b][k] += times * parts[k] / sum(parts)
        weights = {b: [x / sum(f) for x in f] if sum(f) else weights[b] for b, f in found.items()}
    out = {}
    for i, words_ in tokens.items():
        before, out[i] = "<", 0.0
        for w in words_:
            context = single[None if before == "<" else before]
            a, b, c = weights[context.bit_length()]
            out[i] += math.log10(a * pair[before, w] / max(context, 1) + b * single[w] / n + c / (v + 1))
            before = w
    return out


@pytest.mark.parametrize("fold", [5, 9])  # no row has remainder 9: the weights stay as they begin
def test_language_model_scores_by_brute_force(frame, fold):
    rows = [(i, words(30) if i % 3 else "The cat sat ON the mat . the cat ran\tthe cat") for i in range(70)] + [(100, None), (101, ""), (102, "unseen word")]
    rows += [rows[5], (None, "the cat")]
    tokens = {k: [*(t or "").lower().split(), None] for k, (_, t) in enumerate(rows)}
    chosen = {r: [k for k, (i, _) in enumerate(rows) if i is not None and (i % 7 != 2 if r is None else i % 7 == r)] for r in (None, fold)}
    expected = plain_scores(tokens, chosen[None], chosen[fold])
    found = lm.score_documents(frame(rows), F.col("doc_id") % 7 != 2, F.col("doc_id") % 7 == fold).collect()
    key = lambda i: -1 if i is None else i
    assert sorted((key(r.doc_id), round(r.score, 8)) for r in found) == sorted((key(rows[k][0]), round(x, 8)) for k, x in expected.items())


# --- mixing ---------------------------------------------------------------------------------------------

def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 5), ("a", "b")[i % 2], f"s{i % 3}") for i in range(120)] + [(None, None, None, "s9"), (500, "", "a", "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = [F.when(F.col("lang") == "a", 9.0).otherwise(1.0), F.lit(1.0)]
    out = mixing.mix(docs, levels, weights, F.lit(300), epochs=2).collect()
    total = Counter()
    for r in out:
        total[r.lang] += r.n_tokens * r.copies
    supply = sum(len((t or "").split()) for _, t, lang, _ in rows if lang == "a")
    wanted = min(270, 2 * supply)
    assert wanted - 15 <= total["a"] <= wanted and sum(total.values()) <= 300
    assert sum(total.values()) >= 300 - 6 * 5
    assert mixing.mix(docs.limit(0), levels, weights, F.lit(300), epochs=2).count() == 0


@pytest.mark.parametrize("nothing", [0.0, -1.0, None])
def test_mixing_passes_on_what_a_weightless_leaf_holds(spark, nothing):
    rows = [(i, "w", "ab"[i % 2], f"s{i // 2 % 2}") for i in range(400)]  # 100 tokens in each of four leaves
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    leaf = F.when((F.col("lang") == "a") & (F.col("source") == "s0"), F.lit(nothing).cast("double")).otherwise(1.0)
    out = mixing.mix(docs, levels, [F.when(F.col("lang") == "a", 9.0).otherwise(1.0), leaf], F.lit(250), epochs=1).collect()
    taken = Counter((r.lang, r.source) for r in out for _ in range(r.copies))
    assert taken == {("a", "s1"): 100, ("b", "s0"): 75, ("b", "s1"): 75}
    over = mixing.mix(docs, levels, [F.lit(1.0), leaf], F.lit(1000), epochs=1).collect()
    assert sum(r.copies for r in over) == 300
