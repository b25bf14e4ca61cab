from plumbline.llm import licences


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "l", 1) for i, t in rows], "doc_id long, text string, licence string, line int")


def test_every_template_is_found_alone_and_inside_text(spark):
    pad = "anren thou reth or ist une " * 30
    rows = []
    for k, (_, t) in enumerate(licences.TEMPLATES):
        rows += [(3 * k, t), (3 * k + 1, f"first line\n{t}\nlast line"), (3 * k + 2, f"{pad}{t} {pad}")]
    got = {}
    for r in licences.licences(frame(spark, rows)).collect():
        got.setdefault(r.id, []).append(r)
    for k, (name, t) in enumerate(licences.TEMPLATES):
        for j in range(3):
            hits = got[3 * k + j]
            assert [h.licence for h in hits] == [name] and hits[0].n_differences == 0, (name, j)
        assert got[3 * k + 1][0].line == 1


def test_wording_differences_tell_versions_apart(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3 only."), (2, "We talked about a licence yesterday"), (3, None), (4, ""), (5, "licensed " * 30000), (None, "Released under the MIT License."), (6, "Released under the MIT License."), (6, "Released under the MIT License.")]
    got = sorted(((r.id or 0), r.licence, r.n_differences) for r in licences.licences(frame(spark, rows)).collect())
    assert got == [(0, "mit", 0), (1, "gpl-3.0", 0), (6, "mit", 0), (6, "mit", 0)]
    later = next(t for n, t in licences.TEMPLATES if n == "gpl-3.0-or-later").replace("any later", "every new").replace("redistribute", "share")
    assert [(x["licence"], len(x["differences"])) for x in licences.Matcher().scan(later)] == [("gpl-3.0-or-later", 6)]
    assert licences.licences(frame(spark, rows).limit(0)).collect() == []


def test_reductions_rank_the_right_template_first():
    m = licences.Matcher()
    for i, t in enumerate(m.templates):
        first = m.templates[m.reductions(t.words, list(range(len(m.templates))))[0][2]]
        assert first.licence == t.licence and " ".join(t.words) in " ".join(first.words), i  # itself, or a longer wording of the same licence


def edited(r, words, share):
    """words with a share of them left out, replaced or followed by another one."""
    out = []
    for w in words:
        kind = r.randrange(3) if r.random() < share else None
        out += [[], ["other"], [w, "more"]][kind] if kind is not None else [w]
    return out


def brute(m, words):
    """All confirmed matches of all templates in the whole text, without gate, blocks or compression."""
    found = []
    for i, t in enumerate(m.templates):
        for start, stop, diff in t.matches(words, 0, len(words)):
            found.append((len(diff), -len(t.words), i, start, stop))
    taken, out = set(), []
    for _, _, i, start, stop in sorted(found):
        if not taken & set(range(start, stop)):
            taken |= set(range(start, stop))
            out.append((m.templates[i].licence, start, stop))
    return sorted(out, key=lambda x: x[1])


def test_against_brute_force_over_all_templates():
    import random

    r, m = random.Random(3), licences.Matcher()
    names, rows = 0, 0
    for k in range(240):
        t = m.templates[k % len(m.templates)]
        text = [r.choice(["under", "software", "copyright", "the", "of", "licence", "noise", "public"]) for _ in range(r.randrange(40))] + edited(r, t.words, 0.0 if k < 60 else 0.1)
        text += [r.choice(["notice", "work", "license", "copy", "and", "source", "x"]) for _ in range(r.randrange(40))]
        want = brute(m, text)
        got = [(x["licence"], x["start"], x["stop"]) for x in m.scan(" ".join(text))]
        names += [x[0] for x in got] == [x[0] for x in want]
        rows += 1
    assert names >= 0.97 * rows, (names, rows)


def test_no_template_matches_another_licence():
    m = licences.Matcher()
    for text, want in (
        ("Released under the BSD License.", []),
        ("SPDX-License-Identifier: GPL-2.0", []),
        ("SPDX-License-Identifier: Apache-2.0", ["apache-2.0"]),
        ("# SPDX-License-Identifier: MIT\n", ["mit"]),
        ("the software is provided as is,\n * without warranty", ["mit-warranty"]),
        ("Creative Commons Attribution 4.0 International", ["cc-by-4.0"]),
        ("We licensed it under a licence of our own", []),
    ):
        assert [x["licence"] for x in m.scan(text)] == want, text


def test_several_notices_of_a_block_and_wrapped_ones(spark):
    import textwrap

    rows = [(1, "Released under the MIT License. Licensed under CC BY 4.0."), (2, "Released under the MIT License. " * 3 + "and more"), (3, " ".join(t for _, t in licences.TEMPLATES))]
    want = {1: ["mit", "cc-by-4.0"], 2: ["mit"] * 3, 3: [n for n, _ in licences.TEMPLATES]}
    for k, (name, t) in enumerate(licences.TEMPLATES):
        for j, width in enumerate((20, 35, 72)):
            rows.append((100 + 3 * k + j, "a first line\n\n" + textwrap.fill(t, width) + "\n\na last line"))
            want[100 + 3 * k + j] = [name]
    rows.append((90, "/*\n" + textwrap.fill(licences.TEMPLATES[3][1], 40, initial_indent=" * ", subsequent_indent=" * ") + "\n */"))
    want[90] = ["mit"]
    got = {}
    for r in licences.licences(frame(spark, rows)).collect():
        got.setdefault(r.id, []).append(r)
    assert {i: [r.licence for r in sorted(x, key=lambda r: (r.line, r.start))] for i, x in got.items()} == want
    broken = {i for i, t in rows if i >= 100 and licences.words_of(licences.TEMPLATES[(i - 100) // 3][1]) != licences.words_of(t)[3:-3]}  # a narrow line cuts a word in two
    assert len(broken) < 4 and all(r.n_differences == 0 for i, x in got.items() if i not in broken for r in x)
    assert all((r.line, r.start) == (2, 3) for i, x in got.items() for r in x if i >= 100)
    assert [(r.start, r.stop) for r in sorted(got[1], key=lambda r: r.start)] == [(0, 5), (5, 11)]


def test_the_rank_by_saved_bytes_decides_and_the_wording_confirms():
    """A whole notice with a word cut in two holds a clause of its licence without a difference: the notice saves the larger share
    of its bytes and wins, although its wording differs more."""
    m = licences.Matcher()
    name, notice = max(((n, t) for n, t in licences.TEMPLATES if n == "apache-2.0"), key=lambda x: len(x[1]))
    text = notice.replace("licenses/", "li censes/")
    whole = licences.words_of(text)
    exact = [i for i, t in enumerate(m.templates) if t.licence == name and any(not diff for _, _, diff in t.matches(whole, 0, len(whole)))]
    assert exact  # a plainer rule, the fewest differences, would take one of these
    (found,) = m.scan(text)
    assert found["licence"] == name and found["differences"] and found["stop"] - found["start"] == len(whole)
    # what compression ranks first is nothing without its wording
    mixed = sorted(licences.words_of(notice))
    assert m.reductions(mixed, [i for i, t in enumerate(m.templates) if t.licence == name])[0][0] > 0 and m.scan(" ".join(mixed)) == []
