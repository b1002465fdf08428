"""Column functions that read numbers and typed values out of text, in the locale of the vocabulary given.

Each result keeps to nullable columns: what can't be read is null. Vocabulary comes as a mapping, so a
language is data, not code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import in_parens, list_split, minus, sort_key

#: Values of coins in gold pieces, fixed values.
COINS = {"pc": 0.01, "pp": 0.1, "pe": 0.5, "po": 1.0, "ppt": 10.0}
UNITS = {"asalto": "asalto", "minuto": "minuto", "hora": "hora", "dia": "día", "ano": "año"}
#: Units of casting times, and how abilities are abbreviated, fixed values.
CASTING_UNITS = {"minuto": "minuto", "hora": "hora", "dia": "dia"}
ABILITIES = {"Fue": "fue", "Des": "des", "Con": "con", "Int": "int", "Sab": "sab", "Car": "car"}
SIZES = {"diminuto": "Diminuto", "diminuta": "Diminuto", "pequeno": "Pequeño", "pequena": "Pequeño", "mediano": "Mediano", "mediana": "Mediano", "grande": "Grande", "enorme": "Enorme", "gigantesco": "Gigantesco", "gigantesca": "Gigantesco", "gargantuesco": "Gargantuesco", "gargantuesca": "Gargantuesco"}


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """The key's value in a small fixed mapping, null if absent."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def _group(s: Column, pattern: str, n: int) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, n), F.lit(""))


def number(s: Column) -> Column:
    """The first fraction anywhere, else the first signed decimal with point or comma."""
    t = minus(s)
    top, under = _group(t, r"(-?\d+)\s*/\s*(\d+)", 1).cast("double"), _group(t, r"(-?\d+)\s*/\s*(\d+)", 2).cast("double")
    plain = F.replace(_group(t, r"(-?\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit(".")).cast("double")
    return F.coalesce(F.when(under != 0, top / under), plain)


def grouped_number(s: Column) -> Column:
    """A number with points between thousands and a decimal comma."""
    return F.translate(_group(minus(s), r"(-?\d[\d.]*(?:,\d+)?)", 1), ",.", ".").try_cast("double")


def price(s: Column, coins: Mapping[str, float] = COINS) -> tuple[Column, Column, Column]:
    """Amount, coin and worth in gold, four places."""
    pattern = r"(?i)^\s*(\d[\d.]*(?:,\d+)?)\s*(" + "|".join(sorted(coins, key=len, reverse=True)) + r")\b"
    amount = grouped_number(_group(s, pattern, 1))
    coin = F.lower(_group(s, pattern, 2))
    return amount, coin, F.bround(amount * lookup(coin, coins), 4)


def weight(s: Column) -> Column:
    return grouped_number(_group(s, r"(?i)(\d[\d.]*(?:,\d+)?)\s*kg\b", 1))


def fraction_display(x: Column) -> Column:
    """A dash for null, 1/n below one, else the number without a needless .0."""
    return F.when(x.isNull(), "—").when((x > 0) & (x < 1), F.concat(F.lit("1/"), F.round(1 / x).cast("int").cast("string"))).when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def reach(s: Column) -> tuple[Column, Column, Column]:
    """A range's kind, metres and shape."""
    k = sort_key(s)
    value = number(s) * F.when(k.contains("km"), 1000.0).otherwise(1.0)
    kind = F.when(k.startswith("lanzador"), "self").when(k.startswith("toque"), "touch").when(k.startswith("vista") | k.startswith("a la vista"), "sight").when(k.startswith("ilimitado"), "unlimited").when(k.rlike(r"\d"), "ranged").otherwise("special")
    return kind, F.when(kind == "ranged", value), in_parens(s)


def duration(s: Column, units: Mapping[str, str] = UNITS) -> tuple[Column, Column, Column, Column]:
    """Whether it needs concentration, kind, value and unit; value and unit only where it is timed and has both."""
    k = sort_key(s)
    unit, value = _group(k, "(" + "|".join(units) + ")", 1), number(s)
    kind = F.when(k.contains("instantaneo"), "instantaneous").when(k.rlike("hasta que se disipe|disipado"), "until-dispelled").when(k.contains("especial"), "special").otherwise("timed")
    timed = (kind == "timed") & unit.isNotNull() & value.isNotNull()
    return k.startswith("concentracion"), kind, F.when(timed, value), F.when(timed, lookup(unit, units))


def casting_time(s: Column, units: Mapping[str, str] = CASTING_UNITS) -> tuple[Column, Column, Column, Column, Column]:
    """Kind (a time unless an action), ritual, value, unit and a reaction's trigger, without its "que"."""
    k = sort_key(s)
    unit = _group(k, "(" + "|".join(units) + ")", 1)
    kind = F.when(k.startswith("accion adicional"), "bonus-action").when(k.startswith("accion"), "action").when(k.startswith("reaccion"), "reaction").otherwise("time")
    return kind, k.contains("ritual"), F.when(kind == "time", number(s)), F.when(kind == "time", lookup(unit, units)), F.when(kind == "reaction", _group(s, r",\s*(?:que\s+)?(.*)$", 1))


def components(s: Column) -> tuple[Column, Column, Column, Column, Column]:
    """V, S, M, the material (where M is there) and whether it is used up."""
    head = F.regexp_extract(s, r"^([^(]*)", 1)
    material = F.trim(_group(s, r"\(((?:[^()]|\([^()]*\))*)\)", 1))
    m = head.rlike(r"\bM\b")
    material = F.when(m, material)
    return head.rlike(r"\bV\b"), head.rlike(r"\bS\b"), m, material, F.coalesce(sort_key(material).contains("consume"), F.lit(False))


def meta_line(s: Column, sizes: Mapping[str, str] = SIZES) -> tuple[Column, Column, Column, Column]:
    """Type, size, alignment and tags of "type (tags) size, alignment"; the last comma outside parentheses counts."""
    head, alignment = F.coalesce(_group(s, r"^(.*),([^,]*)$", 1), s), F.trim(_group(s, r"^(.*),([^,]*)$", 2))
    words = F.filter(F.split(F.regexp_replace(head, r"\([^()]*\)", " "), r"\s+"), lambda w: w != "")
    size = F.get(F.filter(F.transform(words, lambda w: lookup(sort_key(w), sizes)), lambda x: x.isNotNull()), F.lit(0))
    rest = F.filter(words, lambda w: lookup(sort_key(w), sizes).isNull() & ~F.lower(w).isin("o", "más", "y"))
    return F.array_join(rest, " "), size, alignment, F.coalesce(list_split(in_parens(head), ","), F.array().cast("array<string>"))


def speeds(s: Column, mode: str = "caminando") -> Column:
    """Map of way of moving to metres."""
    parts = list_split(F.regexp_replace(s, r"(\d),(\d)", "$1.$2"), ",")
    pair = lambda p: F.struct(F.coalesce(F.nullif(F.lower(F.trim(F.regexp_extract(p, r"^([^\d]*)", 1))), F.lit("")), F.lit(mode)).alias("k"), number(p).alias("v"))
    return F.map_from_entries(F.filter(F.transform(parts, pair), lambda x: x["v"].isNotNull()))


def abilities(s: Column, names: Mapping[str, str] = ABILITIES) -> Column:
    """Map of ability to score, modifier and save from "Fue 16 +3 +3 Des 13 ..."."""
    pattern = r"\b(" + "|".join(names) + r")\s+(-?\d+)\s+([+-]?\d+)\s+([+-]?\d+)"
    each = lambda n: F.regexp_extract_all(minus(s), F.lit(pattern), F.lit(n))
    zipped = F.arrays_zip(each(1).alias("a"), each(2).alias("b"), each(3).alias("c"), each(4).alias("d"))
    entry = lambda x: F.struct(lookup(x["a"], names), F.struct(x["b"].cast("int").alias("score"), x["c"].cast("int").alias("mod"), x["d"].cast("int").alias("save")))
    last = F.filter(zipped, lambda x, i: ~F.exists(F.slice(zipped, i + 2, F.size(zipped)), lambda y: y["a"] == x["a"]))
    return F.map_from_entries(F.transform(last, entry))


def signed_map(s: Column) -> Column:
    """Map of name to signed bonus from "Name +3, Other -1"."""
    t = minus(s)
    return F.map_from_arrays(F.transform(F.regexp_extract_all(t, F.lit(r"([^,+-]+?)\s*([+-]\s*\d+)"), F.lit(1)), lambda x: F.trim(x)), F.transform(F.regexp_extract_all(t, F.lit(r"([^,+-]+?)\s*([+-]\s*\d+)"), F.lit(2)), lambda x: F.replace(x, F.lit(" "), F.lit("")).cast("int")))


def challenge(s: Column) -> tuple[Column, Column, Column, Column]:
    """Rating, experience, proficiency bonus and experience in the lair of "1/4 (50 PX; BC +2)" or "10 (5900 PX, o 7200 en la guarida; BC +4)"; blanks may stand between thousands."""
    t = minus(s)
    pattern = r"^\s*([\d/]+)\s*\(([\d\s]+)\s*PX[^;)]*(?:;\s*BC\s*([+-]?\d+))?"
    whole = lambda x: F.regexp_replace(x, r"\s", "").try_cast("bigint")
    rated = _group(t, pattern, 1)
    lair = F.when(rated.isNotNull(), _group(t, r"o\s+([\d\s]+)\s+en la guarida", 1))
    return number(rated), whole(_group(t, pattern, 2)), _group(t, pattern, 3).try_cast("int"), whole(lair)


def hit_points(s: Column) -> tuple[Column, Column]:
    """Average and dice formula, dashes read as minus, blanks squeezed."""
    pattern = r"^\s*(\d+)\s*(?:\((\d+d\d+(?:\s*[+-]\s*\d+)?)\))?"
    t = minus(s)
    return _group(t, pattern, 1).try_cast("int"), F.regexp_replace(_group(t, pattern, 2), r"\s+", " ")


def initiative(s: Column) -> tuple[Column, Column]:
    pattern = r"([+-]?\d+)\s*(?:\((\d+)\))?"
    t = minus(s)
    return _group(t, pattern, 1).try_cast("int"), _group(t, pattern, 2).try_cast("int")


def spell_subtitle(s: Column) -> tuple[Column, Column, Column, Column]:
    """Level, cantrip, school and classes of "School de nivel N (classes)" or "Truco de school (classes)"."""
    level = _group(s, r"(?i)^(.+?) de nivel (\d)", 2).try_cast("int")
    trick = s.rlike(r"(?i)^truco de ")
    school = F.coalesce(_group(s, r"(?i)^truco de ([^(]+?)\s*(?:\(|$)", 1), _group(s, r"(?i)^(.+?) de nivel \d", 1))
    return F.when(trick, 0).otherwise(level), trick, F.concat(F.upper(F.substring(school, 1, 1)), F.lower(F.substring(school, 2, 999))), F.coalesce(list_split(in_parens(s), ","), F.array().cast("array<string>"))


def item_subtitle(s: Column, rarities: Mapping[str, str]) -> tuple[Column, Column, Column, Column, Column]:
    """Category, variant, rarity, attunement and who may attune."""
    k = sort_key(s)
    tuned = F.regexp_extract(s, r"(?i)\((requiere sintonizaci[oó]n[^()]*)\)", 1)
    by = F.trim(_group(tuned, r"(?i)sintonizaci[oó]n (?:con|por)\s+(.+)$", 1))
    rarity = F.lit(None).cast("string")
    for name in sorted(rarities, key=len):  # the longest is tried first
        rarity = F.when(k.contains(name), rarities[name]).otherwise(rarity)
    return F.trim(_group(s, r"^([^,(]+)", 1)), F.trim(_group(s, r"^[^,(]+\(([^()]*)\)\s*,", 1)), rarity, tuned != "", by


def bracket_kind(s: Column) -> tuple[Column, Column]:
    """Name and kind of "Name [kind]"."""
    kind = _group(s, r"\[([^\[\]]+)\]\s*$", 1)
    return F.trim(F.regexp_replace(s, r"\s*\[[^\[\]]+\]\s*$", "")), kind


def level_title(s: Column) -> tuple[Column, Column]:
    """Level and name of "Nivel N: Name"."""
    return _group(s, r"(?i)^nivel (\d+):\s*(.+)$", 1).try_cast("int"), _group(s, r"(?i)^nivel (\d+):\s*(.+)$", 2)


def spell_list_level(s: Column) -> Column:
    return F.when(sort_key(s).contains("trucos"), 0).otherwise(_group(s, r"(\d)", 1).try_cast("int"))


def title_price(s: Column) -> tuple[Column, Column]:
    """Name and price of "Name (10 po)"."""
    pattern = r"^(.*?)\s*\((\d[\d.,]*\s*[a-z]+)\)\s*$"
    return F.coalesce(_group(s, pattern, 1), s), _group(s, pattern, 2)


def contents_entry(s: Column) -> tuple[Column, Column]:
    """Title and page of a contents line with leader dots; page null if the line has none."""
    pattern = r"^(.*?)\s*[.…]{2,}\s*(\d+)\s*$"
    return F.coalesce(_group(s, pattern, 1), F.trim(F.regexp_replace(s, r"[.…]{2,}\s*$", ""))), _group(s, pattern, 2).try_cast("int")


def legendary_uses(s: Column) -> tuple[Column, Column]:
    """Uses (the first number after a colon), and uses in the lair, of "Usos de acción legendaria: 3 (4 en la guarida)"."""
    return _group(s, r":\s*(\d+)", 1).try_cast("int"), _group(s, r"\((\d+)\s+en la guarida\)", 1).try_cast("int")


def uses(s: Column) -> tuple[Column, Column]:
    """A name without its uses, and what its parentheses say of how often it can be used: "Aliento (recarga 5-6)"."""
    found = _group(s, r"(?i)\(([^)]*(?:/d[íi]a|recarga|guarida)[^)]*)\)", 1)
    return F.when(found.isNotNull(), F.trim(F.regexp_replace(s, r"\s*\([^)]*\)\s*$", ""))).otherwise(s), found


def zipped(header: Column, row: Column) -> Column:
    """Header and row as a map; a blank header becomes colN, blank cells are left out, a later column wins."""
    keys = F.transform(header, lambda h, i: F.when(F.trim(h) == "", F.concat(F.lit("col"), (i + 1).cast("string"))).otherwise(F.trim(h)))
    width = F.least(F.size(keys), F.size(row))
    pairs = F.arrays_zip(F.slice(keys, 1, width).alias("k"), F.slice(row, 1, width).alias("v"))
    kept = F.filter(pairs, lambda x: F.trim(x["v"]) != "")
    last = F.filter(kept, lambda x, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)
