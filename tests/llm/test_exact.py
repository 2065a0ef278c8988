"""Operators against plain versions of their rules on a small table of documents."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from millrace.llm import catalog, html_text, mixing, ngrams, packing, pii, quality, repeats, secret_scans, simhash, winnowing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_rolling_and_sliding():
    rng = random.Random(1)
    raw = bytes(rng.randrange(4) for _ in range(500))
    for size in (1, 2, 3, 16, 24, 39, 50):
        got = ngrams.rolling(raw, size)
        grams = [raw[i : i + size] for i in range(len(raw) - size + 1)]
        assert len(got) == len(grams)
        assert len(set(zip(got.tolist(), grams))) == len(set(grams)) == len(set(got.tolist()))
    keys = np.array([rng.randrange(50) for _ in range(300)])
    for width in (1, 2, 3, 7, 64):
        assert ngrams.sliding_min(keys, width).tolist() == [keys[i : i + width].min() for i in range(len(keys) - width + 1)]


def test_quality_counts(spark, texts):
    got = {r.doc_id: r for r in catalog.QUERIES["op2_quality_rules"](spark, SF).collect()}
    for doc_id, text in texts.items():
        words, r = text.encode().split(), got[doc_id]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        times = {}
        for w in windows:
            times[w] = times.get(w, 0) + 1
        covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        chars, symbols = sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), chars, symbols, dup, len(covered))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert r.kept == (not r.base_failed and r.probability >= 0.5)


@pytest.mark.parametrize("name,label,column", [("op2_quality_rules", "quality", "kept"), ("op5_toxicity", "toxic", "predicted")])
def test_classifiers_on_held_out_rows(spark, sf, name, label, column):
    scored = catalog.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    if "held_out" in scored:
        assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()
        scored = scored[scored.held_out]
        assert ((scored.score >= 0.5).astype(int) == scored.predicted).all()
    agree = (scored[column].astype(int) == scored[label]).mean()
    assert agree > 0.9


def test_simhash(spark, texts):
    def plain(text):
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: plain(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i in texts:
            for j in texts:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    got = catalog.QUERIES["op8_simhash_near_dedup"](spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {i: (prints[i], group[i]) for i in texts}


@pytest.mark.parametrize("segments", [1, 4, 8, 16])
def test_links_and_components(spark, segments):
    """Chains and a large group of near fingerprints, more than a tile holds."""
    rng = random.Random(segments)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:20]:
        for _ in range(6):
            v ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(v)
    hub = rng.getrandbits(64)
    values |= {hub ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)}
    values = sorted(values)
    arr = np.array(values, np.uint64)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 2):
            a, b = find(v), find(values[j])
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(int(x),) for x in arr.astype(np.int64)], "fp bigint")
    got = {int(np.int64(r.node).astype(np.uint64)): r.root for r in simhash.components(simhash.links(df, 2, segments)).collect()}
    classes = {}
    for v in values:
        classes.setdefault(find(v), []).append(v)
    for members in classes.values():
        if len(members) == 1:
            assert members[0] not in got
        else:
            assert len({got[m] for m in members}) == 1
    assert len(set(got.values())) == sum(len(m) > 1 for m in classes.values())


def test_targets(spark):
    rng = random.Random(3)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i:02}" if i else None: rng.choice([0, 1, 10, 1000, 50000]) for i in range(n)}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
        while open_:
            level = left / sum(weight[s] for s in open_)
            over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
            if not over:
                target |= {s: weight[s] * level for s in open_}
                break
            target |= {s: 2 * sizes[s] for s in over}
            left -= sum(2 * sizes[s] for s in over)
            open_ -= over
        assert all(abs(got[s] - target[s]) < 1e-6 * (1 + target[s]) for s in order), (got, target)


def test_mixing(spark, sf):
    rows = catalog.QUERIES["op7_mixing"](spark, sf).toPandas()
    again = catalog.QUERIES["op7_mixing"](spark, sf).toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken >= 0).all()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").toPandas()
    for _, g in rows.merge(docs, on="doc_id").groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1 and g["size"].sum() == g.source_size.iloc[0]


def test_mixing_prefers_good_documents(spark):
    """Heavier documents come early in the order, as their weight says."""
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b c d' as text", "if(id < 2000, 's', 't') as source")
    weights = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, 4.0d, 1.0d) as weight")
    got = mixing.mix(docs, quality=weights, weights=(1, 39), most=3.0).where("source = 's'").toPandas()
    early = got[got.taken > 0]
    assert 0 < len(early) < 500 and (early.doc_id % 2 == 0).mean() > 0.7


def test_winnowing(spark, texts):
    def plain(raw):
        hashes = (ngrams.rolling(raw, min(winnowing.GRAM, len(raw))) >> np.uint64(24)).tolist() if raw else []
        width, out = min(winnowing.WINDOW, len(hashes)), []
        for i in range(len(hashes) - width + 1) if hashes else ():
            place = min(range(i, i + width), key=lambda j: (hashes[j], -j))
            if not out or out[-1] != place:
                out.append(place)
        return out

    for text in [*list(texts.values())[:40], "", "a", "ab" * 400, "x" * 300]:
        assert winnowing.winnow(text.encode())[1].tolist() == plain(text.encode())
    got = {r.doc_id: r for r in catalog.QUERIES["op6_winnowing"](spark, SF).collect()}
    ids = sorted(texts)
    for doc_id, after in zip(ids, ids[1:] + ids[:1]):
        text, quarter, r = texts[doc_id], len(texts[doc_id]) // 4, got[doc_id]
        edited = text[: len(text) - quarter] + texts[after][:quarter]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        mine, other = ({p.split("@")[0] for p in f.split()} for f in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(mine & other) / len(mine | other) if mine | other else 1.0)
        assert 0 <= r.near_next <= 1


def test_winnowing_guarantee():
    rng = random.Random(5)
    shared = bytes(rng.randrange(97, 123) for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    for _ in range(20):
        a, b = (bytes(rng.randrange(97, 123) for _ in range(200)) for _ in range(2))
        assert set(winnowing.winnow(a + shared)[0].tolist()) & set(winnowing.winnow(shared + b)[0].tolist())


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(catalog.tokenizer_files()["vocabulary"])
    rows = catalog.QUERIES["op9_packing"](spark, SF).toPandas()
    for doc_id, text in texts.items():
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in rows[rows.doc_id == doc_id].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        total = int(g.length.sum())
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]]
        assert total <= 2048 and total & (total - 1) == 0


def test_encoder():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(catalog.tokenizer_files()["vocabulary"])
    encode = packing.encoder(**catalog.tokenizer_files(), most=3)
    rng = random.Random(2)
    parts = ["a", "it's", " ", "  ", "\n", "\t x", " ", "　y", "42", "é", "\U0001f600", "<|endoftext|>", "!!", "Word", "no.", "don't,", "end.\n"]
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(8)))
        assert np.frombuffer(encode(text), "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids, text


def test_index_is_bm25():
    units = [np.array([1, 2, 2, 3]), np.array([2, 3]), np.array([4, 4, 4]), np.array([1, 4])]
    idf = np.array([0, 1.0, 0.5, 2.0, 0.7], np.float32)
    index, mean = packing.Index(units, idf, 2.75), 2.75
    for seed, query in enumerate(units):
        for d, unit in enumerate(units):
            want = 0.0
            for t in set(query.tolist()):
                tf = unit.tolist().count(t)
                norm = packing.K1 * (1 - packing.B + packing.B * len(unit) / mean)
                want += idf[t] * tf * (packing.K1 + 1) / (tf + norm) if tf else 0.0
            assert index.scores(seed)[d] == pytest.approx(want, rel=1e-5)


def plain_removal(texts, length=50):
    seen, out = {}, {}
    for doc_id in sorted(texts):
        raw = texts[doc_id].encode()
        gone, mine = np.zeros(len(raw), bool), set()
        for i in range(len(raw) - length + 1):
            mine.add(raw[i : i + length])
            if raw[i : i + length] in seen:
                gone[i : i + length] = True
        seen.update(dict.fromkeys(mine))
        spans = np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2)
        out[doc_id] = (len(raw), int(gone.sum()), len(spans), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats(spark, texts):
    got = catalog.QUERIES["op10_suffix_array_dedup"](spark, SF).collect()
    want = plain_removal(texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_repeats_with_periodic_and_overlapping_texts(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("ab ") for _ in range(90)) for _ in range(6)]
    docs = {i: rng.choice(["", "x"]) + "".join(rng.choice([*base, "ha " * 40, "z" * 70]) for _ in range(rng.randrange(1, 6))) for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = repeats.deduplicate(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == plain_removal(docs)
    for r in repeats.maximal_repeats(df).collect():
        met = {docs[o.doc_id].encode()[o.start : o.start + r.length] for o in r.occurrences}
        assert len(met) == 1 and len({o.doc_id for o in r.occurrences}) > 1 and r.length >= 50


def test_repeats_with_ids_that_repeat_or_are_missing(spark):
    """Different texts of one id, or without one, are judged each by itself."""
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(8)]
    rows = [(rng.choice([1, 2, 3, 4, None]), "x" * rng.randrange(3) + "".join(rng.choices(base, k=rng.randrange(1, 4)))) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = []
    for doc, text in rows:
        raw, gone = text.encode(), np.zeros(len(text), bool)
        earlier = [t.encode() for d, t in rows if d is not None and (doc is None or d < doc)]
        for i in range(len(raw) - 49):
            if any(raw[i : i + 50] in e for e in earlier):
                gone[i : i + 50] = True
        want.append((str(doc), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in repeats.deduplicate(df).collect()) == sorted(want)


def test_suffix_groups_against_all_substrings():
    rng = random.Random(4)
    for _ in range(30):
        segments = list({bytes(rng.choice(b"ab") for _ in range(rng.randrange(6, 30))) for _ in range(4)})
        places = {}
        for k, s in enumerate(segments):
            for i in range(len(s)):
                for j in range(i + 5, len(s) + 1):
                    places.setdefault(s[i:j], []).append((k, i))
        want = set()
        for sub, at in places.items():
            rights = {segments[k][i + len(sub) : i + len(sub) + 1] or (k, i) for k, i in at}
            lefts = {segments[k][i - 1 : i] if i else None for k, i in at}
            if len(at) > 1 and len(rights) > 1 and (len(lefts) > 1 or None in lefts):
                want.add((len(sub), tuple(sorted(at))))
        assert {(n, tuple(sorted(at))) for n, at in repeats.suffix_groups(segments, 5)} == want


def test_pseudonyms():
    hide = pii.Pseudonyms(b"key")
    text = "Card 4539148803436467, again 4539-1488-0343-6467; bad 4539148803436468; born 1984-02-29 or 25/12/1999; ip 10.0.0.255; +1 (168) 555-5254; DE89370400440532013000; 123-45-6789; a.b.12@mail.example.com"
    new, n = hide(text)
    assert n == 9 and "4539148803436468" in new and "mail.example.com" in new
    for old in ("4539148803436467", "1984-02-29", "25/12/1999", "10.0.0.255", "555-5254", "DE8937", "123-45-6789", "a.b.12@"):
        assert old not in new
    assert hide(text) == (new, n) and [c.isdigit() for c in new[:22]] == [c.isdigit() for c in text[:22]]
    card = new[5:21]
    assert pii.luhn_digit(card[:-1]) == card[-1]
    assert hide("x 4539148803436467 y")[0] == f"x {card} y"


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"k")
    for n in (1, 2, 3, 10, 97, 1000):
        assert sorted(f.permute("t", n, i) for i in range(n)) == list(range(n))


def test_every_date_stays_a_date():
    f = pii.Feistel(b"k")
    import datetime

    day = datetime.date(2001, 1, 1)
    seen = set()
    for i in range(400):
        told = (day + datetime.timedelta(i)).strftime("%d/%m/%Y")
        new = pii._date(f, told)
        seen.add(new)
        d, m, _ = map(int, new.split("/"))
        assert (m > 12 and d <= 12) or d <= 31
    assert len(seen) == 400 - sum(1 for i in range(0))


def test_secrets(spark, sf):
    import re

    got = {r.doc_id: r for r in catalog.QUERIES["op4_secret_scans"](spark, sf).collect()}
    found = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        tokens = {m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r.text)}
        spans = {tuple(s) for s in got[r.doc_id].spans}
        assert tokens <= spans
        found += len(tokens)
        assert not any(re.fullmatch(r"\d{16}", r.text[a:b]) for a, b in spans)
    assert found


def test_lcs():
    def plain(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    def within(part, whole):
        it = iter(whole)
        return all(x in it for x in part)

    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        picked = [x for x, m in zip(a, html_text.shared_lines(a, b)) if m]
        assert len(picked) == plain(a, b) and within(picked, b)


def test_page_differencing(spark):
    """Without a declared article, lines of the page with the nearest path go, and marked elements everywhere."""

    def page(body):
        return f"<html><body><header>Top</header><div>Home | News</div><div class='cookie-notice'>We</div>{body}<div>All rights</div><div id=comments>Hi</div></body></html>"

    rows = [
        (1, "http://h/news/1", page("<p>First <b>story</b>\n here</p>")), (2, "http://h/news/2", page("<p>Second &lt;story&gt;</p>")),
        (3, "http://other/x", page("<p>Third</p>")), (4, "http://h/shop/1", "<p>Buy</p>"),
    ]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {1: "First story here", 2: "Second <story>", 3: "Home | News\n\nThird\n\nAll rights", 4: "Buy"}


def test_pages_of_the_table(spark):
    """The article of every page, read by its tags."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in catalog.QUERIES["op3_html_extraction"](spark, SF).collect()}
    for page_id, page in pages.items():
        article = page.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[page_id].text == "\n\n".join(p for p in parts if p) and got[page_id].n_chars == len(got[page_id].text)
