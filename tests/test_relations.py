from conftest import rows

from citeloom.operators import documents
from citeloom.operators import relations as r
from citeloom.sources import xml
from citeloom.sources import schemas


def test_every_relation_has_its_schema(scan):
    articles = scan("children.xml")
    for name, df in r.shred(articles).items():
        got = [(f.name, f.dataType) for f in df.schema]
        assert got == [(f.name, f.dataType) for f in schemas.TABLES[name]], name


def test_main_row(spark, corpus):
    from citeloom.sources import xml

    articles = xml.scan_articles(spark, f"{corpus}/pubmed21n0001.xml.gz")
    main = {m.pmid: m for m in r.main(articles).collect()}
    assert sorted(main) == [101, 102, 103]
    one = main[101]
    assert (one.doi, one.pii, one.pmcid) == ("", "", "")
    assert (one.date_completed, one.date_revised) == ("1976-01-16", None)
    assert (one.issn_value, one.issn_type) == ("0006-2944", "Print")
    assert (one.volume, one.issue, one.pub_date) == ("13", "2", "1975-06-01")
    assert (one.pages, one.coi, one.n_references) == ("117-26", None, "None")
    two = main[102]
    assert (two.doi, two.pii, two.pmcid) == ("10.1000/First", "S-102", "PMC102")
    assert (two.issn_value, two.volume, two.pages) == (None, None, "")
    assert two.pub_date == "2004-05-07" and two.n_authors == 1
    assert main[103].pub_date == "1998-12-01"
    assert main[103].medline_date_raw == "1998 Dec-1999 Jan"
    fixed = r.main(articles, free_text="constant").filter("pmid = 103").first()
    assert fixed.pub_date == "2000-01-01"


def test_identifiers_and_pairs(spark, corpus):
    from citeloom.sources import xml

    articles = xml.scan_articles(spark, f"{corpus}/pubmed21n0001.xml.gz")
    assert rows(r.identifiers(articles), "pmid") == [
        (101, "", "Biochemical medicine", "13", 1975, "2", "Jun"),
        (102, "10.1000/First", "Journal B", "", 2004, "", "05"),
        (103, "", "Journal C", "", 0, "", ""),
    ]
    # without a DOI the listed PMID 9103 is not used
    assert rows(r.identifier_pairs(articles)) == [
        (101, ""), (102, "10.1000/First"), (103, ""),
    ]


def test_abstracts(scan):
    assert rows(r.abstract(scan("abstracts.xml")), "pmid", "element_id") == [
        (1, 0, "full", "full", "Whole text."),
        (2, 0, "full", "full", "SUMMARY: First.\nABSTRACT: \nAIM: Last."),
        (2, 1, "SUMMARY", "BACKGROUND", "First."),
        (2, 2, "ABSTRACT", "UNASSIGNED", ""),
        (2, 3, "AIM", "OBJECTIVE", "Last."),
        (3, 0, "full", "full", ": No label.\nOBJECTIVE: No category."),
        (3, 1, "", "", "No label."),
        (3, 2, "OBJECTIVE", "", "No category."),
        (5, 0, "full", "full", ""),
    ]


def test_authors(scan):
    got = rows(r.authors(scan("authors.xml")), "pmid", "auth_order")
    assert got[0] == (
        1, 0, False, True, False, "Makar", "A B", "AB", "Jr", "0000-0002",
        "First place", "1812", "000000012", "grid.1",
    )
    assert got[1] == (
        1, 1, True, False, False, "Study Group", "", "", "", "", "", "", "", "",
    )
    assert got[2][:9] == (1, 2, False, False, True, "Müller", "", "", "")
    assert got[3][:6] == (2, 0, False, True, True, "Solo")
    # identifiers of unknown sources are left out, the author stays
    assert got[4] == (
        3, 0, False, True, True, "Odd", "", "", "", "", "X", "", "", "",
    )
    assert len(got) == 5


def test_children(scan):
    a = scan("children.xml")
    assert rows(r.chem(a)) == [(1, "69-93-2", "Uric Acid", "D014527")]
    assert rows(r.supp_mesh(a)) == [
        (1, "Disease", "C538248", "Amyloid angiopathy"),
        (1, "Protocol", "C040721", "ABDIC protocol"),
    ]
    assert [tuple(x) for x in r.mesh(a).collect()] == [
        (1, 0, False, "D000328", "Adult"),
        (1, 1, False, "D002318", "Cardiovascular Diseases"),
        (1, 1, False, "Q000209", "etiology"),
        (1, 1, True, "Q000401", "mortality"),
    ]
    assert [tuple(x) for x in r.keywords(a).collect()] == [
        (1, "KIE", False, "Birth Rate"),
        (1, "KIE", True, "Doe v. Bolton"),
        (1, "NASA", False, "Space"),
    ]
    assert rows(r.comments_corrections(a)) == [
        (1, "ErratumIn", "J Infect Dis 1998", "corrected", "0"),
        (1, "RetractionOf", "Dunkel EC. J Infect Dis. 1993", "", "8393056"),
    ]
    assert rows(r.notes(a)) == [(1, "Original DateCompleted", "NLM")]
    assert rows(r.space(a)) == [(1, "Biosatellite 2 Project"), (1, "manned")]
    assert rows(r.personal_names(a)) == [(1, "Koop", "C Everett", "CE", "")]
    assert rows(r.languages(a)) == [(1, "eng"), (1, "und")]
    assert rows(r.data_bank(a)) == [
        (1, False, "GENBANK", "AF078607"),
        (1, False, "GENBANK", "AF078608"),
        (1, False, "GENBANK", "AF078609"),
        (1, False, "PDB", ""),
    ]
    assert rows(r.grants(a)) == [
        (1, True, "", "", "Wellcome", "United Kingdom"),
        (1, True, "CA 59327", "CA", "NCI NIH HHS", "United States"),
    ]
    assert rows(r.pub_types(a)) == [
        (1, "D016428", "Journal Article"), (1, "D016454", "Review"),
    ]
    main = r.main(a).filter("pmid = 1").first()
    counts = (
        main.n_chems, main.n_supp_mesh, main.n_mesh, main.n_keyword_lists, main.n_keywords,
    )
    assert counts == (1, 2, 2, 2, 3)
    assert (main.n_references, main.vernacular_title, main.pages) == ("12", "Titre", "1-9")
    assert main.coi == "None declared."


def test_references(scan):
    assert rows(r.refs(scan("references.xml"))) == [
        (1, "", 2, 0, "C. J 2003.", "", "", "S1"),
        (1, "References", 0, 0, "A. 2001.", "12", "10.1/a", ""),
        (1, "References", 0, 1, "B. 2002.", "", "", ""),
        (2, "", 1, 0, "D.", "", "", ""),
    ]


def test_mixed_content(scan):
    def titles(**form):
        return {m.pmid: m.title for m in r.main(scan("mixed.xml"), **form).collect()}

    plain = {3: "Plain & <safe> text", 4: "a < b", 5: "Éçole α–\U0001F9EC", 6: "  padded  "}
    assert titles() == {1: "To x go", 2: "Homo sapiens", **plain}
    assert titles(text="leading") == {1: "To ", 2: None, **plain}
    markup = titles(text="markup")
    assert markup[1] == "To <sub>x</sub> go" and markup[2] == "<i>Homo</i> sapiens"
    assert markup[3] == "Plain &amp; &lt;safe&gt; text"


def test_dates_and_problems(scan):
    a = scan("dates.xml")
    got = {m.pmid: m.pub_date for m in r.main(a).collect()}
    assert [got[i] for i in range(1, 8)] == [
        "2001-01-01", "2001-02-01", "2001-02-03",
        "2001-01-01", "2001-04-01", "2001-07-01", "2001-10-01",
    ]
    assert [got[i] for i in range(11, 21)] == [
        "1998-12-07", "2006-02-01", "2016-01-01", "2018-10-01", "2021-01-01",
        "1998-12-01", "2000-04-01", "1998-01-01", "2003-04-01", None,
    ]
    found = a.select("MedlineCitation.PMID._VALUE", r.problems().alias("p"))
    reasons = {
        x._VALUE: [(p.reason, p.detail, p.kept) for p in x.p] for x in found.collect() if x.p
    }
    assert reasons == {
        "8": [("bad_pub_date", "unknown_season", True)],
        "9": [("bad_pub_date", "unknown_month", True)],
        "10": [("bad_pub_date", "bad_day", True)],
        "20": [("bad_pub_date", "missing_pub_date", True)],
        "21": [("bad_pub_date", "missing_pub_date", True)],
    }


def test_other_problems(scan):
    def reasons(name):
        df = scan(name).select("MedlineCitation.PMID._VALUE", r.problems().alias("p"))
        return {
            x._VALUE: [(p.reason, p.detail, p.kept) for p in x.p]
            for x in df.collect()
            if x.p
        }

    assert reasons("authors.xml") == {
        "3": [
            ("unknown_author_id_source", "VIAF", True),
            ("unknown_affiliation_id_source", "ROR", True),
        ]
    }
    # nested lists are drawn out, nothing of them is lost
    assert reasons("references.xml") == {}


def test_nested_reference_lists_are_flattened(scan):
    found = r.refs(scan("references.xml")).filter("pmid = 2").collect()
    assert [(x.list_index, x.ref_index, x.citation) for x in found] == [(1, 0, "D.")]


def test_reference_lists_of_any_depth(spark, tmp_path):
    """Five levels, siblings after nested lists, empty lists: all in document order."""

    def one(name, *inner):
        refs = "".join(f"<Reference><Citation>{name}{i}</Citation></Reference>\n" for i in range(2))
        return f"<ReferenceList>\n<Title>{name}</Title>\n{refs}{' '.join(inner)}</ReferenceList>\n"

    lists = one("a", one("b", one("c", one("d", one("e"))), one("f")), "<ReferenceList>" + one("g") + "</ReferenceList>") + one("h")
    text = (
        "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID></MedlineCitation>"
        f"<PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/x</ArticleId></ArticleIdList>{lists}</PubmedData>"
        "</PubmedArticle></PubmedArticleSet>"
    )
    (tmp_path / "a.xml").write_text(text)
    found = r.refs(xml.scan_articles(spark, str(tmp_path))).orderBy("list_index", "ref_index").collect()
    assert [x.citation for x in found] == [f"{name}{i}" for name in "abcdefgh" for i in range(2)]
    assert [x.list_title for x in found[::2]] == list("abcdefgh")


def test_text_inside_tags_of_every_mixed_element(spark, tmp_path):
    """Titles, abstracts, affiliations, group names, keywords, suffixes, citations; attributes and entities stay."""
    rich = 'x <i>y <sub a="1&amp;2">&lt;z&gt;</sub></i><br/>&#945;'
    body = (
        f"<ArticleTitle>{rich}</ArticleTitle><Abstract><AbstractText Label='L' NlmCategory='C'>{rich}</AbstractText>"
        f"</Abstract><AuthorList><Author><LastName>A</LastName><Suffix>2<sup>nd</sup></Suffix><AffiliationInfo>"
        f"<Affiliation>{rich}</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>two</Affiliation></AffiliationInfo>"
        f"</Author><Author><CollectiveName>{rich}</CollectiveName></Author></AuthorList><VernacularTitle>{rich}</VernacularTitle>"
    )
    text = (
        f"<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID><Article>{body}</Article><KeywordList Owner='O'>"
        f"<Keyword MajorTopicYN='Y'>{rich}</Keyword></KeywordList><CoiStatement>{rich}</CoiStatement></MedlineCitation><PubmedData>"
        f"<ReferenceList><Reference><Citation>{rich}</Citation></Reference></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>"
    )
    (tmp_path / "a.xml").write_text(text)
    a = xml.scan_articles(spark, str(tmp_path))
    whole = "x y <z>α"
    main = r.main(a).first()
    assert (main.title, main.vernacular_title, main.coi) == (whole,) * 3
    assert rows(r.abstract(a)) == [(1, 0, "full", "full", whole)]
    people = r.authors(a).orderBy("auth_order").collect()
    assert (people[0].affiliation, people[0].suffix, people[1].last_name) == (whole, "2nd", whole)
    assert rows(r.affiliations(a)) == [(1, 0, 0, whole, "", "", ""), (1, 0, 1, "two", "", "", "")]
    assert rows(r.keywords(a)) == [(1, "O", True, whole)]
    assert r.refs(a).first().citation == whole
    markup = r.main(a, text="markup").first().title
    assert markup == 'x <i>y <sub a="1&amp;2">&lt;z&gt;</sub></i><br/>α'
    assert r.main(a, text="leading").first().title == "x "
    doc = documents.documents(a).first()
    assert doc.Article.ArticleTitle == doc.Article.Abstract.Parts[0].Value == doc.KeywordLists[0].Keywords[0].Value == whole
    assert documents.documents(a, text="leading").first().Article.ArticleTitle == "x"
