from farelake.llm import licences
from farelake.llm.licence_texts import WHOLE

MIT = licences.KNOWN[0][1]


def found(spark, df):
    return sorted(map(tuple, licences.licence_matches(spark, df).collect()), key=str)


def test_whole_text_with_other_case_punctuation_and_copyright(spark, docs):
    text = "Copyright (c) 2020 Some One\n\n" + MIT.upper().replace(",", " ;").replace("LICENSE", "LICENCE").replace(". ", ".\n")
    assert found(spark, docs([(1, text), (2, text + " and more")])) == [(1, "document", 0, "MIT")]


def test_licence_files_with_and_without_titles(spark, docs):
    """Each whole text as a file: title, copyright line, wrapped lines, other punctuation and quotes."""
    import textwrap
    rows, want = [], {}
    for name, titles, text in WHOLE:
        for title in titles:
            i = len(rows)
            head = ([title.upper(), ""] if title else []) + ["Copyright (c) 2021, Some One <some@one.org>", "(c) them", ""][:1 + i % 3]
            body = textwrap.wrap(text.replace('"', "\u201c").replace(" license", " licence"), 40 + i)
            rows.append((i, "\r\n".join([*head, *[f" * {x}" for x in body]])))
            want[i] = name
    got = {r.doc_id: r.licence for r in licences.licence_matches(spark, docs(rows)).where("unit = 'document'").collect()}
    assert len(want) > 30 and got == want
    cut = [(i, t[:-30]) for i, t in rows]
    assert licences.licence_matches(spark, docs(cut)).where("unit = 'document'").count() == 0


def test_notice_line_and_spelling(spark, docs):
    text = "words here\r\n  * licenced under the APACHE LICENCE, version 2.0 *\nmore"
    assert found(spark, docs([(1, text)])) == [(1, "line", 2, "Apache-2.0")]


def test_a_one_line_text_matches_as_document_and_line(spark, docs):
    assert found(spark, docs([(9, "MIT License.")])) == [(9, "document", 0, "MIT"), (9, "line", 1, "MIT")]


def test_line_about_copyright_is_not_dropped(spark):
    df = spark.createDataFrame([("x", "copyrighted words\nbody"), ("y", "(c) 2001 me\nbody")], "licence string, text string")
    got = {r.licence for r in licences.known_digests(spark, df).collect()}
    assert got == {"x", "y"} and len({r.digest for r in licences.known_digests(spark, df).collect()}) == 2


def test_wrapped_lines_that_start_with_copyright_are_kept(spark, docs):
    body = MIT.replace("The above copyright notice", "The above\ncopyright notice").replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS")
    assert found(spark, docs([(1, body), (2, "Copyright Some One\n" + body)])) == [(1, "document", 0, "MIT"), (2, "document", 0, "MIT")]


def test_odd_rows(spark, docs, odd):
    assert found(spark, docs(odd)) == []
    assert found(spark, docs([])) == []
    twice = docs([(None, "MIT License.")] * 2)
    assert len(found(spark, twice)) == 4 and found(spark, twice)[0][0] is None
