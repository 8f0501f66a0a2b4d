"""Operators on texts, against brute force and on messy tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import contamination, elias_fano, fuzzy_lines, language, near_duplicates, packing, personal_data, quality, queries, sharding, token_files
from ledgerloom.llm.links import components
from tests.llm.samples import ROWS, changed, documents, messy, prose, words

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


# -- helpers ------------------------------------------------------------------


def test_components(spark):
    made = random.Random(4)
    edges = [(made.randint(0, 400), made.randint(0, 400)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)]
    group = {n: n for e in edges for n in e}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        group[b] = a
    expected = {n: root(n) for e in edges for n in e if e[0] != e[1]}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# -- personal data --------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((m.start(), number, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_fixed_patterns(spark):
    made = random.Random(3)
    alphabet = ["@", ".", "+1", "4111 1111 1111 1111", "4539-5787-6362-1486", "255.1.2.3", "256.1.1.1", "0255.1.2.3", "a", "B", " ", "-", "(", ")", "12", "é", "\n", "%", "1.2.3.4.5.6.7.8", "+44 (20) 7946-0958", "x.y@z-w.co.uk", "日"]
    texts = ["".join(made.choice(alphabet) for _ in range(made.randint(1, 40))) for _ in range(1500)]
    found = personal_data.personal_data(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        expected = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [expected.count(f"{k}:") for k in PATTERNS]
        assert set(filter(None, expected.split(","))) <= set(filter(None, r.spans.split(",")))


def test_context_finds_unseen_identifiers(spark):
    known = [f"Please call the desk on +1 (555) 010-{1000 + 7 * k} today" for k in range(30)]
    unseen = [f"Please call the desk on 555.010.{2000 + 3 * k} today" for k in range(5)]
    other = [f"Order number {10000 + k} was shipped" for k in range(40)]
    rows = {r.doc_id: r for r in personal_data.personal_data(documents(spark, known + unseen + other)).collect()}
    for k, text in enumerate(known + unseen + other):
        added = rows[k].spans if k >= len(known) else ""
        start = text.find("555.010")
        assert added == ("" if k < len(known) or start < 0 else f"phone:{start}:{start + 12}")


def test_long_runs_cost_little():
    assert personal_data.base_spans("a" * 300_000 + "@" + "1" * 300_000) == []
    assert personal_data.base_spans("1" * 300_000 + " " + "+1 " + " " * 300_000) == []


# -- language and quality --------------------------------------------------------


def test_language_of_held_out_documents(spark, sample_folder):
    found = queries.op2_language(spark, sample_folder)
    rows = found.join(queries.table(spark, sample_folder, "documents").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_filter_holds_what_was_put_in(spark):
    rows = [(k, " ".join(words(k % 2, 300)), "ab"[k % 2]) for k in range(20)]
    model = language.learnt(spark.createDataFrame(rows, "id long, text string, lang string"))
    import pyarrow as pa

    for k in range(2):
        codes, _ = language.ngrams(pa.record_batch({"text": [rows[k][1]]}))
        assert (model.masks(codes) >> k & 1).mean() > 0.95
    assert (model.false_positives() < 0.01).all()


def test_quality_of_held_out_documents(spark, sample_folder):
    found = queries.op5_quality(spark, sample_folder).join(queries.table(spark, sample_folder, "labels"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 80 and sum(r.quality == r.predicted for r in rows) >= 0.95 * len(rows)
    assert all((r.score >= 0.5) == (r.predicted == 1) for r in rows)


def test_quality_without_labels(spark):
    docs, labels = messy(spark), spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in quality.classify(docs, labels, learn=F.lit(True)).collect()} == {1}


# -- near duplicates ----------------------------------------------------------------


def near_texts():
    base = [prose(k, 120) for k in range(12)]
    texts = list(base)
    for k, text in enumerate(base[:8]):
        texts += [changed(text, 100 * k + n, n) for n in (1, 2, 4, 9, 20)]
    texts += [base[0]] * 5 + [base[1].upper()] + ["one two three", "one two three", "one two", "", None]
    hub = prose(77, 150)
    return texts + [hub] + [changed(hub, 5000 + k, 2) for k in range(60)]


def test_near_duplicates_are_the_brute_force_classes(spark):
    texts = near_texts()
    settings = near_duplicates.Settings()
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in near_duplicates.near_duplicates(docs).collect()}
    cells = near_duplicates.document_frequencies(docs, settings)
    import pyarrow as pa

    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    sets = [({}, set())] * 0
    weights = {}
    for block, (owner, hashes, counts) in near_duplicates._shingled([batch], settings.size):
        w = near_duplicates.shingle_weights(hashes, counts, cells, len(texts), settings)
        for row in range(block.num_rows):
            weights[len(sets)] = (hashes[owner == row], w[owner == row])
            sets.append(row)
    group = list(range(len(texts)))

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a in range(len(texts)):
        for b in range(a):
            same = (texts[a] or "") == (texts[b] or "")
            if same or near_duplicates.weighted_jaccard(*weights[a], *weights[b]) >= settings.threshold:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert {k: r.class_id for k, r in found.items()} == {k: root(k) for k in range(len(texts))}
    sizes = Counter(root(k) for k in range(len(texts)))
    assert all(r.class_size == sizes[r.class_id] and r.keep == (r.class_id == k) for k, r in found.items())
    kept = near_duplicates.without_copies(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(sizes)


def test_samples_agree_as_weighted_jaccard():
    sampler = near_duplicates.Sampler(3000, 5)
    made = np.random.Generator(np.random.PCG64(2))
    names = np.sort(made.integers(0, 1 << 44, 300, dtype=np.uint64))
    x, y = made.uniform(0.5, 4, 300).astype(np.float32), made.uniform(0.5, 4, 300).astype(np.float32)
    for cut in (300, 200):
        left, right = sampler.draw(names, x, np.array([0]))[0], sampler.draw(names[:cut], y[:cut], np.array([0]))[0]
        expected = near_duplicates.weighted_jaccard(names, x, names[:cut], y[:cut])
        assert abs((left == right).mean() - expected) < 0.04


# -- lines ------------------------------------------------------------------------


def plain(line):
    return " ".join(re.findall(r"[^\W_]+", line.lower()))


def test_lines_are_kept_once(spark):
    shared, near = prose(50, 40), prose(51, 400)
    texts = [
        f"{prose(1)}\n{shared}\nshort line here",
        f"{shared.upper()}\n{prose(2)}\n\nshort line here",
        f"{near}\n{prose(3)}",
        f"{near[:-3]}x\n{prose(4)}\n{shared}",
        shared,
        "",
        None,
    ]
    found = {r.doc_id: r for r in fuzzy_lines.without_repeated_lines(documents(spark, texts)).collect()}
    assert found[0].text == texts[0] and found[1].text == f"{prose(2)}\n\nshort line here"
    assert found[2].text == texts[2] and found[3].text == prose(4)
    assert (found[4].text, found[4].n_dropped, found[4].n_lines) == ("", 1, 1)
    assert (found[5].text, found[6].text, found[6].n_lines) == ("", None, 0)


def test_links_of_lines_are_the_brute_force_ones(spark):
    settings = fuzzy_lines.Settings()
    texts = []
    for k in range(6):
        base = prose(900 + k, 80)
        texts += [base] + [base.replace(base[n : n + 2], "zz", 1) for n in range(5, 200, 13)]
    docs = documents(spark, texts)
    rows = fuzzy_lines.occurrences(docs, "doc_id", "text", settings.words).collect()
    by_line = {r.line: (r.mark, plain(texts[r.id])) for r in rows}
    links = fuzzy_lines.links(docs, spark.createDataFrame([(n, m, 1) for n, (m, _) in by_line.items()], "line long, mark long, n long"), "text", settings)
    found = {r.node: r.component for r in components(links).collect()}

    def edits(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    lines = sorted(by_line)
    group = {n: n for n in lines}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for i, a in enumerate(lines):
        for b in lines[:i]:
            (ma, ta), (mb, tb) = by_line[a], by_line[b]
            if bin((ma ^ mb) & (2**64 - 1)).count("1") <= settings.bits and edits(ta, tb) <= (1 - settings.similarity) * max(len(ta), len(tb)):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert {n: found.get(n, n) for n in lines} == {n: root(n) for n in lines}


# -- packing and token files ---------------------------------------------------------


def token_ids(texts, name, end):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.tokenizer_path(name))
    return {k: np.array(made.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for k, t in enumerate(texts)}


def odd_texts():
    return [prose(k, 10 + 40 * (k % 7)) for k in range(80)] + [
        None, "", "a", " lead", "two  spaces", "tab\there", "\n\nx\n", "3.5, e.g. (a). .b ..", "don't we'll I'm", "<|endoftext|> x",
        "É “q” ÉÀ ß ÿ 日本語。", "x y", "_a_ b_c., d", " ".join(words(9, 3000)),
    ]


def test_packing(spark):
    texts = odd_texts()
    ids = token_ids(texts, BYTE, 0)
    docs = documents(spark, texts).repartition(5)
    rows = packing.pack(docs, queries.tokenizer_path(BYTE), settings=packing.Settings(windows=3, together=2)).collect()
    pieces, sequences = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans, lengths in ((pieces, {k: len(v) for k, v in ids.items()}), (sequences, None)):
        for name, found in spans.items():
            at = 0
            for start, length in sorted(found):
                assert start == at and length > 0
                at += length
            assert at == lengths[name] if lengths else at == 1024 or at & (at - 1) == 0
    assert set(pieces) == set(ids)


def test_token_files(spark, tmp_path):
    texts = odd_texts()
    ids = token_ids(texts, WORD, 1)
    path = str(tmp_path / "files")
    token_files.write(documents(spark, texts).repartition(4), path, queries.tokenizer_path(WORD), end=1, files=5)
    rows = sorted(token_files.read(spark, path).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == sorted(ids)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
        at += r.n_tokens
    content = next(f for f in sorted((tmp_path / "files").glob("part-*")) if f.stat().st_size).read_bytes()
    for block in token_files.blocks_of(content):
        for k in range(block.n):
            name, _, found = block.document(k)
            assert (found == ids[name]).all()


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**15), (700, 300), (1000, 10**17), (5000, 20000)])
def test_elias_fano(n, top):
    values = np.sort(np.random.Generator(np.random.PCG64(n)).integers(0, top, n))
    code = elias_fano.encode(values)
    read = elias_fano.Values(b"##" + code, 2)
    assert (read.all() == values).all() and len(read) == n and read.size == len(code)
    assert [read[k] for k in range(n)] == values.tolist()
    if n >= 1000:
        assert 8 * len(code) < n * (3.6 + np.log2(top / n))
    with pytest.raises(IndexError):
        read[n]


# -- contamination -------------------------------------------------------------------


def test_edited_items_are_found(spark):
    items = [prose(700 + k, 40) for k in range(6)] + ["too short", None, ""]
    benchmark = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(99, items[0])], "item_id long, text string")
    made = random.Random(8)

    def edited(text, n):
        letters = list(text)
        for _ in range(n):
            at = made.randrange(len(letters))
            letters[at : at + 1] = made.choice([[], ["q"], [letters[at], "q"]])
        return "".join(letters)

    texts, allowed = [], []
    for n in (0, 1, 4, 8, 11, 40):
        for k in range(6):
            texts.append(f"{prose(k, 30)} {edited(items[k], n)} {prose(k + 50, 30)}")
    texts += [prose(k, 100) for k in range(20)] + [items[0].upper().replace(" ", " - "), None, ""]
    expected = set()
    for d, text in enumerate(texts):
        folded = " ".join(re.findall(r"[^\W_]+", (text or "").lower())).encode()
        for k, item in enumerate(items[:6]):
            name = " ".join(re.findall(r"[^\W_]+", item.lower())).encode()
            most = len(name) // contamination.Settings().piece - 1
            found = contamination.distance(name, folded, most)
            if found <= most:
                expected |= {(d, i, found) for i in ([0, 99] if k == 0 else [k])}
    rows = contamination.contaminated(documents(spark, texts), benchmark, settings=contamination.Settings(block_bytes=500)).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in rows} == expected and len(rows) == len(expected) > 30
    left = contamination.decontaminated(documents(spark, texts), benchmark).collect()
    assert {r.doc_id for r in left} == set(range(len(texts))) - {d for d, _, _ in expected}


@pytest.mark.parametrize("seed", range(5))
def test_bit_parallel_distance(seed):
    made = random.Random(seed)
    pattern, text = (bytes(made.choice(b"abc") for _ in range(n)) for n in (made.randint(1, 90), made.randint(0, 200)))
    last = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    assert contamination.distance(pattern, text, 1000) == min(last)
    assert contamination.distance(pattern, text, 2) == min(3, min(last))


# -- sharding -------------------------------------------------------------------------


def test_lookup_table():
    shards = [f"s{k}" for k in range(16)]
    table = sharding.lookup_table(shards, 1021)
    loads = Counter(table)
    assert set(loads) == set(range(16)) and max(loads.values()) - min(loads.values()) <= 1
    # By turns, one slot at a time, straight from the definition.
    orders = [[(sharding._hash(f"{s}/offset") % 1021 + j * (sharding._hash(f"{s}/skip") % 1020 + 1)) % 1021 for j in range(1021)] for s in shards]
    slow, turn = {}, 0
    while len(slow) < 1021:
        slow[next(x for x in orders[turn % 16] if x not in slow)] = turn % 16
        turn += 1
    assert table == [slow[k] for k in range(1021)]
    fewer = sharding.lookup_table(shards[:-1], 1021)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 15)
    assert moved < 0.25 * 1021
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 1000)


def test_shards_are_written(spark, tmp_path):
    docs = documents(spark, [prose(k, 5) for k in range(200)])
    sharding.write(docs, "doc_id", ["a", "b", "c"], str(tmp_path / "out"), files=2)
    found = spark.read.parquet(str(tmp_path / "out"))
    placed = {r.doc_id: r.shard for r in sharding.place(docs, "doc_id", ["a", "b", "c"]).collect()}
    assert {r.doc_id: r.shard for r in found.collect()} == placed and found.count() == 200


# -- messy and empty tables -----------------------------------------------------------


def operators(spark):
    benchmark = spark.createDataFrame([(1, prose(2)), (None, prose(3)), (3, None)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 0), (8, 1), (8, 0), (None, 1), (2, None)], "doc_id long, quality int")
    byte, word = queries.tokenizer_path(BYTE), queries.tokenizer_path(WORD)

    def files(docs):
        path = token_files.scratch(spark)
        token_files.write(docs, path, word, end=1, files=3)
        return token_files.read(spark, path)

    return {
        "personal_data": (personal_data.personal_data, ROWS),
        "language": (lambda d: language.identify(d, F.lit(True), F.lit(False)), ROWS),
        "near": (near_duplicates.near_duplicates, ROWS),
        "copies": (near_duplicates.without_copies, None),
        "shards": (lambda d: sharding.place(d, "doc_id", ["a", "b"]), ROWS),
        "quality": (lambda d: quality.classify(d, labels, F.lit(True)), ROWS),
        "lines": (fuzzy_lines.without_repeated_lines, ROWS),
        "pack": (lambda d: packing.pack(d, byte), None),
        "files": (files, ROWS),
        "contaminated": (lambda d: contamination.contaminated(d, benchmark), 2),
        "decontaminated": (lambda d: contamination.decontaminated(d, benchmark), ROWS - 2),
    }


@pytest.mark.parametrize("name", ["personal_data", "language", "near", "copies", "shards", "quality", "lines", "pack", "files", "contaminated", "decontaminated"])
def test_messy_and_empty_tables(spark, name):
    operator, expected = operators(spark)[name]
    rows = operator(messy(spark)).collect()
    assert expected is None or len(rows) == expected
    assert operator(messy(spark).limit(0)).collect() == []
    if name == "near":
        alike = {(r.doc_id, r.class_id, r.class_size) for r in rows}
        assert (None, 1, 3) in alike and (1, 1, 3) in alike and (3, 2, 3) in alike
    if name == "copies":
        # Of the three rows of one text one stays, by the smallest id; the second text of id 1 stays as well.
        assert sorted((r.doc_id for r in rows if r.text == prose(1))) == [1] and any(r.text == prose(2) for r in rows)
