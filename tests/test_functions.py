"""Scalar functions on the awkward cases: nulls, invisible characters, dashes, duplicates."""

from pyspark.sql import functions as F

from quire.functions import parse as P
from quire.functions import text as X
from quire.operators import sequence as Q


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"s {kind}").select(column(F.col("s")).alias("x")).first().x


def test_text(spark):
    assert one(spark, X.slugify, " Águila­ Ñandú ß—x ") == "aguila-nandu-x"
    assert one(spark, X.slugify, None) is None and one(spark, X.slugify, "—") == ""
    assert one(spark, X.clean, "a b‑c​­") == "a b-c"
    assert one(spark, X.unaccented, "éñüÅőá") == "enuAoa"
    assert one(spark, X.emphasised, "*a* **b** ***c*** *d e*") == ["a", "d e"]
    assert one(spark, X.fragment, "short one") is None
    assert one(spark, X.joined_lines, ["so­", "", "­", "ft", " end "], "array<string>") == "soft end"
    assert one(spark, lambda s: X.split_runin(s)[0], "***Bite (Recarga 5).*** text") == "Bite (Recarga 5)"
    assert one(spark, lambda s: X.split_runin(s)[1], "no run-in") == "no run-in"
    assert one(spark, lambda s: X.label_value(s)[1], "a: b: c") == "b: c"
    assert one(spark, X.list_split, "a; b,, c ") == ["a", "b", "c"]


def test_numbers(spark):
    for s, want in (("1/4", 0.25), ("−1,5 m", -1.5), ("x", None), ("3/0", 3.0), ("45", 45.0), (None, None)):
        assert one(spark, P.number, s) == want
    assert one(spark, P.grouped_number, "1.000,5") == 1000.5
    assert one(spark, lambda s: P.price(s)[2], "15 pc") == 0.15 and one(spark, lambda s: P.price(s)[0], "gratis") is None
    assert one(spark, lambda s: P.hit_points(s)[1], "1 (1d4 − 1)") == "1d4 - 1"
    told = lambda f, x: tuple(one(spark, lambda s: f(s)[k], x) for k in range(len(f(F.col("s")))))
    assert told(P.challenge, "1/4 (50 PX; BC +2)") == (0.25, 50, 2, None)
    assert told(P.challenge, "17 (18 000 PX, o 20 000 en la guarida; BC +6)") == (17.0, 18000, 6, 20000)
    assert told(P.challenge, "ninguno") == (None, None, None, None)
    got = one(spark, P.abilities, "Mod. Salv. Fue 16 +3 +3 Des 13 +1 +1 Int 2 −4 −4")
    assert {k: tuple(v) for k, v in got.items()} == {"fue": (16, 3, 3), "des": (13, 1, 1), "int": (2, -4, -4)}
    assert told(P.legendary_uses, "Usos de acción legendaria: 3 (4 en la guarida). Al final del turno") == (3, 4)
    assert told(P.uses, "Aliento de fuego (recarga 5-6)") == ("Aliento de fuego", "recarga 5-6") and told(P.uses, "Mordisco") == ("Mordisco", None)
    assert told(P.duration, "Instantáneo")[1] == "instantaneous" and told(P.duration, "Hasta que se disipe")[1] == "until-dispelled"
    assert told(P.duration, "Concentración, hasta 1 hora") == (True, "timed", 1.0, "hora")
    assert told(P.casting_time, "Reacción, que realizas cuando caes")[4] == "realizas cuando caes" and told(P.casting_time, "1 minuto o ritual")[:4] == ("time", True, 1.0, "minuto")
    assert told(P.reach, "A la vista")[0] == "sight" and told(P.reach, "Lanzador (cono de 9 m)") == ("self", None, "cono de 9 m")
    assert one(spark, lambda s: P.meta_line(s)[2], "Dragón Enorme (cromático, malo), caótico malvado") == "caótico malvado"
    assert one(spark, lambda s: P.meta_line(s)[1], "Humanoide Pequeña o Mediana, neutral") == "Pequeño"
    assert one(spark, lambda s: P.duration(s)[3], "10 años") == "año"
    assert one(spark, lambda s: P.components(s)[3], "V, S, M (polvo (oro) que se consume)") == "polvo (oro) que se consume"
    assert one(spark, P.speeds, "9 m, trepar 4,5 m") == {"caminando": 9.0, "trepar": 4.5}
    assert [one(spark, P.fraction_display, x, "double") for x in (None, 0.125, 2.0, 0.0)] == ["—", "1/8", "2", "0"]


def test_maps(spark):
    row = spark.createDataFrame([(["a", "", "a"], ["1", "2", "3", "4"])], "h array<string>, r array<string>")
    assert row.select(P.zipped(F.col("h"), F.col("r")).alias("m")).first().m == {"a": "3", "col2": "2"}
    assert one(spark, lambda s: Q.labelled_slices(s, ["a:", "b:", "ab:"]), "a: 1 ab: 2 b: 3 a: 4") == {"a:": "4", "ab:": "2", "b:": "3"}


def test_sequences(spark):
    assert one(spark, lambda s: Q.anchored_bands(s, 40), [0.0, 30.0, 41.0, 81.0, 82.0], "array<double>") == [0.0, 41.0, 82.0]
    assert one(spark, Q.split_threshold, [1.0, 12.0, 12.1, 15.0, 0.2], "array<double>") == 13.55
    assert one(spark, Q.split_threshold, [], "array<double>") == 0.0
    rows = spark.createDataFrame([("g", 1, 0, 5), ("g", 2, 3, 4), ("g", 3, 12, 20), ("g", 4, 40, 41)], "g string, i int, a int, b int")
    got = Q.merged_intervals(rows, ["g"], "a", "b", 7).orderBy("run").collect()
    assert [(r.a, r.b, r.n) for r in got] == [(0, 20, 3), (40, 41, 1)]
