"""Labels and names, case by case."""

import pytest
from pyspark.sql import functions as F

from minutemark.functions import scalars
from minutemark.operators import labels

CASES = [
    ("Appellant - Niles Illich", dict(key="nilesillich", kind="person", roles=["appellant"])),
    ("CLO - Susan Gross", dict(key="susangross")),
    ("Judge Patricia O'Caña-Olivarez", dict(key="patriciaocanaolivarez", titles=["judge"], name="Patricia O'Caña-Olivarez")),
    ("JudgePatricia O'Caña-Oli..", dict(key="patriciaocanaoli", truncated=True)),
    ("Pat Benavides CC6 Crt Coordinator", dict(key="patbenavides")),
    ("Katie McGinn (she/her)", dict(key="katiemcginn", tokens=["katie", "mcginn"])),
    ("Appellee (Angela Sullivan)", dict(key="angelasullivan")),
    ("F. Philip Carbullido", dict(key="philipcarbullido")),
    ("Honorable Philip Carbullido", dict(key="philipcarbullido")),
    ("A. Chen", dict(key="achen")),
    ("yolanda/aguilar", dict(key="yolandaaguilar")),
    ("michael:sirignano", dict(key="michaelsirignano")),
    ("Kim Hall", dict(key="kimhall")),
    ("Council Chambers", dict(kind="role")),
    ("Michael's iPad (2)", dict(kind="device")),
    ("Courtroom Clerk", dict(kind="role")),
    ("Talking: Suzanne Swope", dict(key="suzanneswope")),
    ("Jacklyn.Martin@cincinnati-oh.gov", dict(key="jacklynmartin")),
    ("No Speaker", dict(kind="noise", truncated=False)),
    (None, dict(kind="noise")),
    ("Judge Danielle Edy Evidence must be kept until end of trial", dict(kind="runon")),
    ("lanStreightiPad", dict(key="lanstreight")),
    ("Ian Streight iPad", dict(key="ianstreight")),
    ("JeffreyCarroll", dict(tokens=["jeffrey", "carroll"])),
    ("Pat Benavides CC6 Crt Coordinat..", dict(key="patbenavides")),
    ("ADAAdrian Lozano", dict(key="adrianlozano")),
    ("Nicholas Mahrou AD..", dict(key="nicholasmahrou")),
    ("Bianca Rivera CCg Coordi", dict(key="biancarivera")),
    ("Connie Soto Probat", dict(key="conniesoto")),
    ("Pat BenavidesCC6", dict(key="patbenavides")),
    ("Isidro Montoya Jr", dict(key="isidromontoya")),
    ("Juage Patricia", dict(titles=["juage"])),
    ("Pat Benavides Crt", dict(titles=[])),
    ("Mayer Smith", dict(key="mayersmith")),
    ("AJ Garcia", dict(key="ajgarcia")),
    ("Justice Bill Pedersen Ill", dict(key="billpedersen")),
    ("udge Person", dict(key="person")),
    ("stice Evans", dict(key="evans")),
    ("LG Escape Plus", dict(kind="device")),
    ("Dge Smith", dict(key="smith")),
    ("Uday Smith", dict(key="udaysmith")),
    ("Kate Bierman", dict(key="katebierman")),
    ("Rice Johnson", dict(key="ricejohnson")),
    ("Idge Person", dict(key="person")),
    ("Person CE", dict(key="person")),
    ("Lee Smith", dict(key="leesmith")),
    ("Kasting, Irma", dict(key="irmakasting", name="Irma Kasting")),
    ("Gonzalez, Robert R", dict(key="robertgonzalez", name="Robert R Gonzalez")),
    ("Janet, Andersen", dict(name="Janet Andersen")),
    ("Lara, lan", dict(name="lan Lara")),
    ("Attorney, Uzo Mokolo", dict(key="uzomokolo")),
    ("Aida Rojas-Moore", dict(key="aidarojasmoore", name="Aida Rojas-Moore")),
    ("Appellant-John Thetford", dict(key="johnthetford")),
    ("Joyce Johnson / Jennifer Michalik", dict(key="joycejohnson")),
    ("", dict(kind="noise")),
    ("...", dict(kind="noise")),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "label string")
    return {r.label: r for r in labels.parse_labels(rows).collect()}


@pytest.mark.parametrize("label,want", CASES, ids=[str(c[0])[:30] for c in CASES])
def test_parse(parsed, label, want):
    assert {k: parsed[label][k] for k in want} == want


def test_context(spark):
    words = labels.context_words("Montague Township Council", "Ontario, Canada", None)
    assert words == ["canada", "council", "montague", "ontario", "township"]
    rows = spark.createDataFrame([("Montague Townshi..", words), ("Montague", words), ("Montague", [])], "label string, context array<string>")
    got = labels.with_parsed(rows.union(rows)).collect()
    assert len(got) == 6
    assert {(r.label, len(r.context) > 0, r.kind) for r in got} == {
        ("Montague Townshi..", True, "role"), ("Montague", True, "role"), ("Montague", False, "person"),
    }


def values(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_scalars(spark):
    lit = F.lit
    r = values(
        spark,
        fold=scalars.fold(lit("O'Caña-Olivarez")),
        perez=scalars.fold(lit("Pérez Søren")),
        same=scalars.skeleton(lit("michaellsirignano")) == scalars.skeleton(lit("michaelsirignano")),
        ones=scalars.skeleton(lit("corina1elozano")) == scalars.skeleton(lit("corinalelozano")),
        alike=scalars.similarity(lit("kitten"), lit("sitting")),
        none=scalars.similarity(lit(""), lit("")),
        prefix=scalars.prefix_match(lit("patricia"), lit("patriciaocana")),
        slip=scalars.prefix_match(lit("patriciaocama"), lit("patriciaocanaoli")),
        suffix=scalars.suffix_match(lit("dobson"), lit("billdobson")),
        equal=scalars.suffix_match(lit("dobson"), lit("dobson")),
        sur=scalars.surname(F.array(lit("robert"), lit("j"), lit("torres"))),
        given=scalars.given(F.array(lit("robert"))),
        cuts=scalars.boundaries(lit("roberttorres"), F.array(lit("robert"), lit("j"), lit("torres"))),
        time=scalars.timestamp(lit(3_723_004_500).cast("long"), ","),
        stem=scalars.file_id(lit("/a/council.2021-05-04.mp4")),
        stem2=scalars.file_id(lit("out/council.2021-05-04.ocr.json")),
        stem3=scalars.file_id(lit("x.stats.json")),
    )
    assert (r.fold, r.perez, r.same, r.ones) == ("ocanaolivarez", "perezsren", True, True)
    assert r.alike == pytest.approx(1 - 3 / 7) and r.none == 1
    assert (r.prefix, r.slip, r.suffix, r.equal) == (True, True, True, False)
    assert (r.sur, r.given, r.cuts) == ("torres", "", [6])
    assert (r.time, r.stem, r.stem2, r.stem3) == ("01:02:03,004", "council.2021-05-04", "council.2021-05-04", "x.stats")
