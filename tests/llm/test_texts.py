import hashlib
import math
import random
from collections import Counter
from functools import lru_cache
import re

import numpy as np
import pytest

from logtables.llm import decontamination, html_text, licenses, token_counts


# ---------------------------------------------------------------- decontamination
def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(window, len(b))
        if item is None or not n:
            continue
        for i in range(len(b) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j: j + n] == b[i: i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_chars", [16_000_000, 60])
def test_matches_equal_brute_force(spark, docs, block_chars):
    rng = random.Random(5)
    letters = ["a", "b", "B", "c", "é", "x1"]
    make = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(letters) for _ in range(n))
    items = [(k, make(rng.randrange(1, 12))) for k in range(8)] + [(3, make(4)), (None, "a b c"), (90, None), (91, ""), (92, "!!")]
    rows = [(i, make(rng.randrange(0, 60))) for i in range(60)] + [(None, "a b a b"), (7, None), (8, ""), (9, make(20_000)), (9, "a b")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(docs(rows), bench, window=4, block_chars=block_chars).collect()
    expected = sorted((str(i), *brute_force(t, items, 4)) for i, t in rows if t is None or len(t) < 9_000)
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(r["items"])) for r in found if r.n_words < 9_000)
    assert got == expected
    assert len(found) == len(rows)
    for r in found:
        assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
        covered = {k for s in r.spans for k in range(s.start, s.start + s.length)}
        assert len(covered) == r.n_hit
    texts = {i: words(t) for i, t in items if i is not None and i != 3}
    for r in found:
        mine = [words(t) for i, t in rows if i == r.doc_id and len(words(t)) == r.n_words]
        for s in r.spans:
            if s.item_id in texts and len(mine) == 1:
                assert mine[0][s.start: s.start + s.length] == texts[s.item_id][s.item_start: s.item_start + s.length]


@pytest.mark.parametrize("kind", ["smallint", "double", "decimal(20,2)", "date", "string"])
def test_item_ids_of_any_type(spark, docs, kind):
    number = "date_add(date'2024-01-01', id)" if kind == "date" else "id"
    bench = spark.sql(f"select cast({number} as {kind}) as item_id, t as text from values (1, 'a b c'), (2, 'x y'), (null, 'b') as v(id, t)")
    ids = [r.item_id for r in bench.orderBy("item_id").collect()][1:]
    found = decontamination.contamination(docs([(1, "b a b c x"), (2, "x y a b c"), (3, None)]), bench, window=3).orderBy("doc_id").collect()
    assert [r["items"] for r in found] == [ids[:1], ids, []]
    assert [[s.item_id for s in r.spans] for r in found] == [ids[:1], ids[::-1], []]


def longest_matches(text, items, window):
    w, found = words(text), set()
    for item, t in items:
        b = words(t)
        n = min(window, len(b))
        pairs = {(j, i) for i in range(len(b) - n + 1) for j in range(len(w) - n + 1) if n and w[j: j + n] == b[i: i + n]}
        for j, i in pairs:
            if (j - 1, i - 1) not in pairs:
                m = next(m for m in range(len(w) + 1) if (j + m + 1, i + m + 1) not in pairs)
                found.add((j, n + m, item, i))
    return sorted(found)


@pytest.mark.parametrize("block_chars", [16_000_000, 60])
def test_spans_are_all_longest_matches(spark, docs, block_chars):
    rng = random.Random(7)
    make = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    a, b, c = "s t u v w x y z", "u v w x y z one two three", "v w x y p v w x y q"
    items = [(1, a), (2, b), (3, c), (4, "k k k k k k k"), (5, "k k")] + [(10 + k, make(rng.randrange(1, 12))) for k in range(8)]
    rows = [(1, f"so {b} end"), (2, f"{a} {b}"), (3, c), (4, "k " * 15), (5, "v w x y"), (6, "")] + [(10 + k, make(40)) for k in range(12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(docs(rows), bench, window=4, block_chars=block_chars).collect()
    got = {r.doc_id: sorted((s.start, s.length, s.item_id, s.item_start) for s in r.spans) for r in found}
    assert got == {i: longest_matches(t, items, 4) for i, t in rows}
    assert (1, 9, 2, 0) in got[1]


def test_clean_rows_keep_their_columns(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five")], "item_id bigint, text string")
    rows = docs([(1, "zero ONE two-three four five"), (2, "one two three"), (3, None), (None, "x")])
    kept = decontamination.decontaminate(rows, bench)
    assert kept.schema == rows.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]
    assert decontamination.decontaminate(docs([]), bench).count() == 0
    assert decontamination.decontaminate(rows, bench.where("false")).count() == 4


# ---------------------------------------------------------------- HTML
PAGES = [
    (None, ""), ("", ""), ("   ", ""), ("plain words only", "plain words only"), ("<p>a&amp;b &lt; c&nbsp;d", "a&b < c d"),
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/x'>Home</a></nav><article><h1>Head</h1><p><b>Bo"
     "ld</b>er text.<br>Next<p>More <!-- no --> here</p></article><aside>side</aside><footer>foot</footer></body></html>",
     "Head Bolder text. Next More here"),
    ("<body><header>Top</header><main><p>In <a href=x>a link</a>, all.</p><form><input value=1><button>Go</button></form><script>var t='</p>'"
     ";</script><section class='comments'><p>First!</p></section></main></body>", "In a link, all."),
    ("<div class=menu>Menu here</div><div class=content><p>This is the text, it is long enough to count. It has marks.</p><p>Short.</p></div>"
     "<div id='cookie-notice'><p>We use cookies.</p></div><div class='ad'>Buy now</div>",
     "This is the text, it is long enough to count. It has marks. Short."),
    ("<article><p>unclosed <i>tags <p>go on</article>", "unclosed tags go on"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>", "one two 1 2"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


STORY = "<p>" + "It was late, and the road was long; nobody spoke, not even the driver. " * 4 + "</p>"
STORY_TEXT = " ".join(STORY[3:-4].split())
LINKS = "<ul>" + "<li><a href=/x>Elsewhere</a></li>" * 5 + "</ul>"


def test_ratios_decide_on_marked_and_unmarked_pages():
    cards = "<article class=card><h3><a href=/1>First teaser</a></h3></article><article class=card><h3><a href=/2>Second</a></h3></article>"
    assert html_text.main_text(f"<body><div class=story>{STORY * 3}</div>{cards}</body>") == " ".join([STORY_TEXT] * 3)
    assert html_text.main_text(f"<body><div class=story>{STORY * 3}</div><article class=card><p>A teaser.</p></article></body>").startswith(STORY_TEXT)
    # inside a marked part, paths of links go; parts without a mark go if they are weak
    assert html_text.main_text(f"<article>{STORY}{LINKS}</article><div class=x><p>Buy.</p></div>") == STORY_TEXT
    assert html_text.main_text(f"<div class=x>{STORY}{LINKS}</div>") == STORY_TEXT
    # one and the same path, once in a marked part
    assert html_text.main_text(f"<div><p>Weak.</p></div><div role=main>{STORY}</div>") == STORY_TEXT


SIDE = "<div class=sidebar><p>Some other words, and a few more.</p></div>"


@pytest.mark.parametrize("page", [
    f'<article class="post category-social">{STORY}</article>{SIDE}',
    f'<div role=main class="share"><p></p>{STORY}</div>{SIDE}',
    f'<div class="no-sidebar">{STORY}{SIDE}</div>', f'<div class="has-sidebar">{STORY}{SIDE}</div>', f'<div id=social><div>{STORY}</div>{SIDE}</div>',
    f'<div class="ad-free share-ready">{STORY}</div>{SIDE}', f'<div class="page-widget">{STORY}</div>{SIDE}',
    f'<body><form id="aspnetForm"><div>{STORY}</div>{SIDE}<form><fieldset><p>Search here.</p></fieldset></form></form></body>',
    f'<form><article>{STORY}</article>{SIDE}</form>',
    f'<div class="skip"><div>{STORY * 2}</div></div><article class=card><p>A teaser.</p></article>',
    f'<article><svg class="icon" viewBox="0 0 1 1"/>{STORY}</article>{SIDE}', f'<article><math/>{STORY}<math><mi>x</mi></math></article>{SIDE}',
    f'<article><svg width=1><path d="M0"/>{STORY}</article>{SIDE}', f'<article><svg><text>x</text></svg>{STORY}</article>{SIDE}',
])
def test_names_and_forms_lose_no_page(page):
    assert STORY_TEXT in html_text.main_text(page)
    assert "other words" not in html_text.main_text(page)


def test_names_still_lower_their_parts():
    comments = "<section class=comments><article class=comment><p>First, and not the last!</p></article></section>"
    for page in (f"<article>{STORY}</article>{comments}", f"<div>{STORY}</div>{comments}", f"<main>{STORY}{comments}</main>",
                 f"<div>{STORY}</div><form><p>Your name, please.</p></form>", f"<div>{STORY}</div><div class='page-footer'><p>Some words.</p></div>"):
        assert html_text.main_text(page) == STORY_TEXT


def reader_comments(n, name):
    return f"<section {name}>" + "".join(f"<div><p>{'I have read it twice, and I do not agree; others may. ' * 3}{i}</p></div>" for i in range(n)) + "</section>"


@pytest.mark.parametrize("name", ['id="comments"', "class=comments", 'class="comment-list"', 'id="disqus_thread"', 'class="user-comments box"', 'id="respond"', 'class="replies"'])
@pytest.mark.parametrize("n", [1, 6, 20, 100])
def test_reader_comments_are_never_content(n, name):
    comments = reader_comments(n, name)
    for page in (f"<article>{STORY}</article>{comments}", f"<article>{STORY}{comments}</article>", f"<body><div>{STORY}</div>{comments}</body>",
                 f"<main><article>{STORY}</article>{comments}</main>", f"<div class=story>{STORY}{comments}</div>"):
        assert html_text.main_text(page) == STORY_TEXT


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div role=main>%s</div>", "<body><div class=story>%s</div></body>", "<article class='post comments-open has-comments'>%s</article>"])
def test_short_parts_inside_the_content_stay(wrap):
    inner = (f"<h1>Title</h1>{STORY * 3}<h2>Part</h2><blockquote>Quoted, once.</blockquote><pre>a = 1</pre><ul><li>One</li><li>Two</li></ul>"
             "<table><tr><td>Cell</td><td>7</td></tr></table><dl><dt>Term</dt><dd>Sense</dd></dl>"
             f"<figure><img src=x><figcaption>A view</figcaption></figure>{LINKS}<div class=share>Share it.</div>{STORY * 2}")
    text = html_text.main_text(wrap % inner + SIDE + "<footer>foot</footer>")
    middle = "Part Quoted, once. a = 1 One Two Cell 7 Term Sense A view"
    assert " ".join([STORY_TEXT] * 3 + [middle] + [STORY_TEXT] * 2) in text and "Elsewhere" not in text and "Share" not in text


def brute_ratios(paths):
    """Weights of unmarked, unlowered paths, in page order, straight from the description."""
    ratios = [(t / n, m / n) for t, m, n in paths]
    out = []
    for i in range(len(paths)):
        near = [ratios[max(0, i - 1)], ratios[i], ratios[i], ratios[min(len(paths) - 1, i + 1)]]
        out.append(sum(a for a, _ in near) / 4 * (1 + sum(b for _, b in near) / 4))
    return out


def test_ratios_equal_brute_force():
    """Sections of one paragraph class each: which of them stay is what the plain formula says."""
    rng = random.Random(8)
    for _ in range(200):
        sections = [[" ".join("word" * rng.randint(1, 2) + rng.choice(["", ",", "."]) for _ in range(rng.choice([1, 3, 30]))) for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 6))]
        page = "".join(f"<div class=c{i}x>" + "".join(f"<div>{t}</div>" for t in texts) + "</div>" for i, texts in enumerate(sections))
        weights = brute_ratios([(sum(map(len, texts)), sum(t.count(",") + t.count(".") for t in texts), len(texts)) for texts in sections])
        expected = [t for texts, w in zip(sections, weights) if w >= html_text.SHARE * max(weights) for t in texts]
        assert html_text.main_text(page) == " ".join(expected)


def test_pages(spark):
    rows = [(i, p, "old", "x") for i, (p, _) in enumerate(PAGES)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string, row string")
    found = html_text.extract_main_text(pages)
    assert found.columns == ["page_id", "row", "text"]
    assert sorted((r.page_id, r.text) for r in found.collect()) == sorted((i, t) for i, (_, t) in enumerate(PAGES) for _ in range(2))
    assert html_text.extract_main_text(pages.where("false")).count() == 0


# ---------------------------------------------------------------- token counts
def best_count(model, word):
    best = [(0.0, 0)] + [(-float("inf"), 0)] * len(word)
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * model.unknown, -(best[end - 1][1] + size))]
        for start in range(end):
            score = model.scores.get(word[start:end])
            if score is not None:
                options.append((best[start][0] + score, -(best[start][1] + 1)))
        score, tokens = max(options)
        best[end] = (score, -tokens)
    return best[-1][1]


def test_trie_counts_equal_separate_ones():
    rng = random.Random(1)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(25)}
    model = token_counts.Unigram({p: -rng.randrange(1, 9) / 2 for p in pieces}, -9.0)
    made = {"".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 12))) for _ in range(800)} | {"abc" * 400}
    assert dict(model.terminals(list(made))) == {w: best_count(model, w) for w in made}


def test_tries_by_level_equal_single_walks(monkeypatch):
    rng = random.Random(2)
    pieces = {"".join(rng.choice("abé日") for _ in range(rng.randrange(1, 5))) for _ in range(30)}
    words = {"".join(rng.choice("abcé日\U0001f600") for _ in range(rng.randrange(0, 14))): rng.randrange(1, 9) for _ in range(700)}
    for scores in ({p: -rng.randrange(1, 4) / 2 for p in pieces}, {}):
        model = token_counts.Unigram(scores, -3.0)
        monkeypatch.setattr(token_counts, "LONG", -1)
        counts, used = dict(model.terminals(list(words))), model.piece_counts(words)
        monkeypatch.setattr(token_counts, "LONG", 64)
        for block in (1, 7, 1000):
            monkeypatch.setattr(token_counts, "BLOCK", block)
            assert dict(model.terminals(list(words))) == counts and model.piece_counts(words) == used
    assert dict(model.terminals([])) == {} and not model.piece_counts({})


def trained(path, words, rounds=token_counts.ROUNDS):
    """Viterbi training of the plain kind: every word of every text by itself, best cuts by recursion over them."""
    model = token_counts.Unigram.from_sentencepiece(path)

    @lru_cache(maxsize=None)
    def cuts(model, word):
        if not word:
            return 0.0, 0, ()
        score, fewest, pieces = cuts(model, word[:-1])
        size = len(word[-1].encode())
        best = score + size * model.unknown, -(fewest + size), pieces
        for start in range(len(word)):
            s = model.scores.get(word[start:])
            if s is not None:
                score, fewest, pieces = cuts(model, word[:start])
                best = max(best, (score + s, -(fewest + 1), (*pieces, word[start:])), key=lambda b: b[:2])
        return best[0], -best[1], best[2]

    for _ in range(rounds):
        counts = Counter(piece for w in words for piece in cuts(model, "▁" + w)[2])
        total = math.log(sum(counts.values()) + len(model.scores))
        scores = {p: math.log(counts[p] + 1) - total for p in model.scores}
        model = token_counts.Unigram(scores, min(scores.values()) - token_counts.BYTE_PENALTY)
    return model


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_piece_scores_equal_plain_training(spark, docs, rounds):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(rounds)
    texts = [" ".join(rng.choice(["house", "houses", "thehouse", "日本", "unrelated", "x9\U0001f600"]) for _ in range(30)) for _ in range(40)]
    found = token_counts.fit_unigram(docs(list(enumerate(texts)) + [(50, None), (51, "")]).repartition(3), path, rounds=rounds)
    plain = trained(path, [w for t in texts for w in t.split()], rounds)
    assert found.scores == pytest.approx(plain.scores) and found.unknown == pytest.approx(plain.unknown)
    if rounds:
        assert found.scores["▁house"] > token_counts.Unigram.from_sentencepiece(path).scores["▁house"]


def test_token_counts_of_documents(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(1, "the house the"), (1, "the house the"), (None, "日本 \U0001f600"), (2, None), (3, ""), (4, " \n "), (5, "xyz " * 30_000)]
    found = token_counts.token_counts(docs(rows), path).collect()
    model = trained(path, [w for _, t in rows for w in (t or "").split()])
    expected = sorted((str(i), len((t or "").split()), sum(best_count(model, "▁" + w) for w in (t or "").split()[:100]) * (300 if i == 5 else 1)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in found) == expected
    assert token_counts.token_counts(docs([]), path).count() == 0


# ---------------------------------------------------------------- licenses
def test_license_scan(spark):
    mit = "Released under the MIT License."
    files = [
        ("a/LICENSE", licenses.TEMPLATES[0][1]), ("a/x.py", "no licence here"), ("a/b/c/y.py", "print(1)"), ("a/b/own.py", f"# head\n{mit}\ncode\n" * 2),
        ("ab/z.py", "z"), ("a/b/LICENSE.txt", licenses.TEMPLATES[4][1]), ("top.py", ""), (None, None), (None, mit), ("a/x.py", "no licence here"),
        ("long/t.txt", "lorem ipsum license " * 20_000), ("long/u.txt", "dolor\n" * 5_000 + mit),
    ]
    rows = spark.createDataFrame([(p, t, "old", "f") for p, t in files], "path string, text string, license string, folder string")
    found = licenses.scan_licenses(rows, "path")
    assert found.columns == ["path", "folder", "license", "score", "origin"]
    got = sorted((str(r.path), str(r.license), str(r.origin)) for r in found.collect())
    assert got == sorted([
        ("a/LICENSE", "Apache-2.0", "file"), ("a/x.py", "Apache-2.0", "inherited"), ("a/x.py", "Apache-2.0", "inherited"), ("a/b/c/y.py", "MIT", "inherited"),
        ("a/b/own.py", "MIT", "header"), ("ab/z.py", "None", "None"), ("a/b/LICENSE.txt", "MIT", "file"), ("top.py", "None", "None"),
        ("None", "None", "None"), ("None", "MIT", "file"), ("long/t.txt", "None", "None"), ("long/u.txt", "MIT", "header"),
    ])
    assert licenses.scan_licenses(rows.where("false"), "path").count() == 0


MIT_FILE = """The MIT License (MIT)

Copyright (c) 2019 Ann Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_licence_files_and_texts_inside_files(spark):
    texts = dict(licenses.full_texts())
    held = "Copyright (c) 2020, Some Company Inc.\nAll rights reserved.\n\n"
    code = "".join(f"def step_{i}(value):\n    return value * {i} + other_{i}\n\n" for i in range(60))
    comment = "".join(f"# {line}\n" for line in MIT_FILE.split("\n"))
    # a sentence that is wrapped, amid lines that speak of licences too
    permission = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\n" \
                 "files (the \"Software\"), to deal in the Software without restriction\n"
    amid = "The program may use any form of the work, see the public file.\nFor the version of the documentation see the other file.\n" * 3
    files = {
        "mit/LICENSE": (MIT_FILE, "MIT", "file"), "bsd3/LICENSE": (held + texts["BSD-3-Clause"], "BSD-3-Clause", "file"),
        "bsd2/LICENSE": (held + texts["BSD-2-Clause"], "BSD-2-Clause", "file"), "apache/LICENSE": (texts["Apache-2.0"], "Apache-2.0", "file"),
        "gpl2/COPYING": (texts["GPL-2.0"], "GPL-2.0", "file"), "gpl3/COPYING": (texts["GPL-3.0"], "GPL-3.0", "file"),
        "agpl/COPYING": (texts["AGPL-3.0"], "AGPL-3.0", "file"), "lgpl/COPYING": (texts["LGPL-3.0"], "LGPL-3.0", "file"),
        "mit/x/y.py": (code, "MIT", "inherited"), "gpl3/x.c": ("int main;", "GPL-3.0", "inherited"),
        "code/a.py": (code + comment + code, "MIT", "header"), "code/b.py": (code, "None", "None"),
        "code/c.txt": (amid + permission + amid, "MIT", "header"), "code/d.txt": (amid, "None", "None"),
    }
    rows = spark.createDataFrame([(p, t) for p, (t, _, _) in files.items()], "path string, text string")
    found = {r.path: (str(r.license), str(r.origin)) for r in licenses.scan_licenses(rows, "path").collect()}
    assert found == {p: (name, origin) for p, (_, name, origin) in files.items()}


def test_words_in_reach_lose_no_passage():
    rng = random.Random(3)
    texts = [("Long", " ".join(x for _, x in licenses.TEMPLATES[:9])), ("Zlib", dict(licenses.full_texts())["Zlib"])]
    matcher = licenses.Matcher(licenses.TEMPLATES, 50, {"the": 45, "license": 9}, 0.7, texts)
    tried = inside = 0
    for _ in range(300):
        _, text = rng.choice(licenses.TEMPLATES + texts)
        words = text.split()
        for at in range(rng.randrange(0, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(["the", "other", "copy\n", "\n\n"]))
        passage = " ".join(words)
        alone = matcher.best(passage)
        assert not alone[1] or matcher.scan(passage)[0] is not None
        width, words = rng.randrange(4, 14), text.split()
        wrapped = "\n".join("rem " + " ".join(words[i: i + width]) for i in range(0, len(words), width))
        prose = "the license of other prose and more prose\n" * 30
        if matcher.best(wrapped)[0] > 0.8:
            inside += matcher.scan(f"{prose}{wrapped}\n{prose}")[0] is not None
            tried += 1
    assert tried == inside > 100
    # the run that is kept while sliding is the best of all runs
    lines = [[rng.choice("abcdefgh") for _ in range(rng.randrange(1, 5))] for _ in range(60)]
    words, starts = [w for line in lines for w in line], np.cumsum([0, *map(len, lines)])
    small = licenses.Matcher([("T", "a b c d a b")], 9, {"a": 5}, 0.2)
    runs = [(int(starts[i]), int(starts[i + 2])) for i in range(len(lines) - 1)]
    highest = max(small.cosines(words[a:b])[0] for a, b in runs)
    assert small.cosines(words[slice(*small.nearest_run(words, runs, 0))])[0] == pytest.approx(highest)


def test_cues_lose_no_passage():
    rng = random.Random(2)
    matcher = licenses.Matcher(licenses.TEMPLATES, 100, {"the": 90, "license": 9, "under the": 50}, 0.7)
    vocabulary = [t for _, x in licenses.TEMPLATES for t in licenses.WORD.findall(x.lower())]
    for _ in range(3000):
        passage = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 8)))
        if matcher.best(passage)[1]:
            assert not matcher.cues.isdisjoint(licenses.WORD.findall(passage))
