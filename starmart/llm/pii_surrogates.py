"""Surrogates for personal data.

E-mail addresses, phone, card and social security numbers, IBANs, IP addresses
(both versions) and names after one or more titles are found by one regex.
Each distinct entity gets a replacement of its own type and format, derived
from a secret key: digits stay digits, letters stay letters of their script
and case, separators stay where they are, cards keep a valid check digit, IPv6
groups their lengths and zeros, given names their gender: that of the title,
else of the person or given name where other titles tell it. What is one
entity stays one (the same number in two formats, one domain of many
addresses, one person under several titles, one surname with and without a
given name), in every document and every run with that key. Replacements that
meet each other, or a real entity, are drawn again until all are distinct.

Once a document has named a person, that given name and surname are replaced
wherever they stand alone later in it, in the same letters (words that are
spelt like the name included). Names before that, or without any title, stay.

Only the distinct entities take part in that; documents are joined to the
result by entity, and rebuilt from the pieces between matches. Everything is
DataFrame work.

Results in odd cases: null text stays null and empty text empty; text without
entities is unchanged; rows that repeat doc_id and text are treated alike, and
other rows under one (or a null) doc_id are kept apart by their text; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import persist

# Titles by gender, and what the kinds look like.
TITLES = {"f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|mrs|ms|frau|señora|sra|madame|mme",
          "m": "Mr|Herr|Señor|Sr|Monsieur|mr|herr|señor|sr|monsieur", "n": "Dr|Prof|dr|prof"}
DEGREES = r"h\. ?c\.|med\.|phil\.|jur\.|Ing\."  # after Dr and Prof
_TITLE = f"(?:{'|'.join(TITLES.values())})"
#: One or more titles and the space after them.
_TITLES = rf"{_TITLE}\.?(?: {_TITLE}(?!\p{{L}})\.?| (?:{DEGREES}))*+ "
#: A capitalised word that is no title, without a possessive s.
_NAME = rf"(?!{_TITLE}(?!\p{{L}}))\p{{Lu}}(?:\p{{L}}|(?!['’]s(?!\p{{L}}))['’-](?=\p{{L}}))++"
_HEX = "[0-9A-Fa-f]{1,4}"
SHAPES = {
    "email": r"[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}",
    "ip6": rf"(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}}|(?=[A-Fa-f]*\d)[0-9A-Fa-f]{{4}}:(?::{_HEX}){{1,6}}",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d(?:[ -]?\d){12,18}",
    "person": rf"{_TITLES}{_NAME}(?: {_NAME})?",
}
#: A match begins and ends where its word does.
_EDGES = {"email": (r"(?<![\p{L}\p{N}._%+-])", ""), "person": (r"(?<!\p{L})", ""),
          "ip": (r"(?<![\p{L}\d.])", r"(?!\.?\d)(?!\p{L})"), "ip6": (r"(?<![\p{L}\d:.])", r"(?![\p{L}\d:]|\.\d)")}
_EDGE = (r"(?<![\p{L}\d])", r"(?![\p{L}\d])")
PATTERN = "|".join(f"{a}(?:{SHAPES[k]}){b}" for k in SHAPES for a, b in [_EDGES.get(k, _EDGE)])
#: A text without any of these holds no entity: all kinds but e-mail addresses and names have two digits side by side
#: or, as single-digit octets and spaced cards, with one separator between; IPv6 has two colons.
MAYBE = rf"@|[0-9][ .-]?[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]|{_TITLE}\.? \p{{Lu}}"
#: Where a name could stand alone.
MENTION = rf"(?<![\p{{L}}\p{{N}}])(?<!\p{{L}}['’-]){_NAME}(?!\p{{N}})"

# Letters to draw from, by script; consonants and vowels for names.
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρστφ", "αεηιο")}
ENDINGS = {"latin": {"f": "a", "m": "o", "n": "en"}, "cyrillic": {"f": "а", "m": "ан", "n": "ей"}, "greek": {"f": "α", "m": "ος", "n": "ι"}}
DIGITS, HEX = "0123456789", "0123456789abcdef"
MAX_BROADCAST_ROWS = 200_000
#: Draws before an error: names and e-mail addresses grow from the eighth on, so only a fixed format that the corpus
#: has nearly filled can come so far.
MAX_ATTEMPTS = 40


def _pick(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at % len(alphabet) + 1, 1)


def _byte(h: Column, i: Column) -> Column:
    """The i-th byte of a hash in hexadecimal (of 64, then from the start)."""
    return F.conv(F.substring(h, (i % 64) * 2 + 1, 2), 16, 10).cast("int")


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _script(s: Column) -> Column:
    return (F.when(s.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(s.rlike(r"\p{IsGreek}"), F.lit("greek"))
            .otherwise(F.lit("latin")))


def _drawn(s: Column, h: Column, keep: Column | None = None) -> Column:
    """Each digit and letter of lower-case ``s`` drawn anew, in its script."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(h, i)
        new = (F.when(c.between("0", "9"), _pick(DIGITS, b)).when(~c.rlike(r"\p{L}"), c)
               .when(c.rlike(r"\p{IsCyrillic}"), _pick(LETTERS["cyrillic"], b))
               .when(c.rlike(r"\p{IsGreek}"), _pick(LETTERS["greek"], b)).otherwise(_pick(LETTERS["latin"], b)))
        return new if keep is None else F.when(i < keep, c).otherwise(new)

    return F.array_join(F.transform(_chars(s), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of digits, every second from the right (with a check digit to come) doubled."""
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    d = F.reverse(_chars(digits))
    return F.aggregate(F.transform(d, lambda c, i: F.when(i % 2 == 0, twice(c.cast("int"))).otherwise(c.cast("int"))),
                       F.lit(0), lambda a, x: a + x)


def _card_ok(canon: Column) -> Column:
    return (_luhn(F.expr("substring(canon, 1, length(canon) - 1)")) + F.substring(canon, -1, 1).cast("int")) % 10 == 0


def _name(h: Column, script: Column, syllables: int, gender: str | None = None) -> Column:
    out = None
    for s, (consonants, vowels) in SYLLABLES.items():
        parts = [p for i in range(syllables) for p in (_pick(consonants, _byte(h, F.lit(2 * i))), _pick(vowels, _byte(h, F.lit(2 * i + 1))))]
        if gender:
            parts[-1] = F.lit(ENDINGS[s][gender])
        made = F.concat(*parts)
        out = F.when(script == s, made) if out is None else out.when(script == s, made)
    return out


def _ip6_expanded(e: Column) -> Column:
    """All 32 digits of an IPv6 address."""
    def groups(half: Column) -> Column:
        return F.transform(F.filter(F.split(F.lower(half), ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))

    left, right = groups(F.substring_index(e, "::", 1)), groups(F.substring_index(e, "::", -1))
    short = F.concat(left, F.array_repeat(F.lit("0000"), F.lit(8) - F.size(left) - F.size(right)), right)
    return F.array_join(F.when(F.contains(e, F.lit("::")), short).otherwise(left), "")


def _ip6_drawn(canon: Column, h: Column) -> Column:
    """Each digit drawn anew but for the leading zeros of its group."""
    nonzero = HEX[1:]

    def one(c: Column, i: Column) -> Column:
        head = F.substring(canon, i - i % 4 + 1, i % 4)  # of the group, before this digit
        zeros = ~head.rlike("[^0]")
        b = _byte(h, i)
        return F.when(~zeros, _pick(HEX, b)).when(c == "0", c).otherwise(_pick(nonzero, b))

    return F.array_join(F.transform(_chars(canon), one), "")


def _ip6_rendered(e: Column, new: Column) -> Column:
    """The 32 digits of ``new`` in the groups and lengths of ``e``."""
    def groups(half: Column) -> Column:
        return F.filter(F.split(half, ":"), lambda g: g != "")

    def filled(of: Column, first: Column) -> Column:
        return F.array_join(F.transform(of, lambda g, k: F.substring(new, (first + k + 1) * 4 - F.length(g) + 1, F.length(g))), ":")

    left, right = groups(F.substring_index(e, "::", 1)), groups(F.substring_index(e, "::", -1))
    out = F.when(F.contains(e, F.lit("::")), F.concat(filled(left, F.lit(0)), F.lit("::"), filled(right, F.lit(8) - F.size(right))))
    out = out.otherwise(filled(left, F.lit(0)))
    return F.when(e == F.upper(e), F.upper(out)).otherwise(out)


def _surrogate(key: str) -> Column:
    """Replacement of (kind, canon) at an attempt, in canonical form."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt").cast("string")
    h = _hash(key, kind, canon, attempt)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    tld = F.substring_index(domain, ".", -1)
    host = F.expr("substring(substring_index(canon, '@', -1), 1, length(substring_index(canon, '@', -1)) "
                  "- length(substring_index(canon, '.', -1)))")
    # many attempts: the format has few members, so let it grow
    longer = F.when(F.col("attempt") >= 8, _drawn(F.lit("0000"), F.sha2(h, 512))).otherwise("")
    email = F.concat(_drawn(local, h), longer, F.lit("@"), _drawn(host, _hash(key, F.lit("domain"), host)), tld)
    octets = [((_byte(h, F.lit(2 * i)) * 256 + _byte(h, F.lit(2 * i + 1))) % 254 + 1).cast("string") for i in range(4)]
    head = _drawn(F.expr("substring(canon, 1, length(canon) - 1)"), h, F.lit(1))
    card = F.concat(head, ((10 - _luhn(head) % 10) % 10).cast("string"))
    script = _script(canon)
    grown = F.when(F.col("attempt") >= 8, _name(F.sha2(h, 512), script, 2)).otherwise("")
    return (F.when(kind == "email", email).when(kind == "ip", F.concat_ws(".", *octets)).when(kind == "card", card)
            .when(kind == "ip6", _ip6_drawn(canon, h))
            .when(kind == "phone", _drawn(canon, h, F.when(F.substring(canon, 1, 1) == "+", 2).otherwise(0)))
            .when(kind == "iban", _drawn(canon, h, F.lit(2))).when(kind == "surname", F.concat(_name(h, script, 3), grown))
            .when(kind == "given_f", F.concat(grown, _name(h, script, 3, "f")))
            .when(kind == "given_m", F.concat(grown, _name(h, script, 3, "m")))
            .when(kind == "given_n", F.concat(grown, _name(h, script, 3, "n"))).otherwise(_drawn(canon, h)))


def _kind(entity: Column) -> Column:
    out = None
    for k, shape in SHAPES.items():
        test = entity.rlike(rf"^(?:{shape})$")
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return out


def _parts(entities: DataFrame) -> DataFrame:
    """entity, kind and parts: what of the entity is replaced, each with its
    kind and canonical form (a name has up to two)."""
    e = F.col("entity")
    plain = (F.when(F.col("kind") == "email", F.lower(e)).when(F.col("kind") == "ip", e).when(F.col("kind") == "ip6", _ip6_expanded(e))
             .otherwise(F.lower(F.regexp_replace(e, r"[^+0-9A-Za-z]", ""))))

    def part(kind: Column, canon: Column) -> Column:
        return F.struct(kind.alias("kind"), canon.alias("canon"))

    kinds = entities.withColumn("kind", _kind(e))
    found = kinds.filter("kind <> 'person'").withColumn("canon", plain)
    found = found.filter((F.col("kind") != "card") | _card_ok(F.col("canon")))
    found = found.select("entity", "kind", F.array(part(F.col("kind"), F.col("canon"))).alias("parts"))

    title = F.regexp_extract(e, f"^{_TITLES}", 0)
    gender = reduce(lambda out, g: out.when(title.rlike(rf"(?<!\p{{L}})(?:{TITLES[g]})(?!\p{{L}})"), F.lit(g)), "fm",
                    F.when(F.lit(False), "")).otherwise("n")
    names = F.split(F.lower(F.regexp_replace(e, f"^{_TITLES}", "")), " ")
    people = persist(kinds.filter("kind = 'person'").select(
        "entity", "kind", gender.alias("gender"), F.when(F.size(names) == 2, names[0]).alias("given"),
        F.element_at(names, -1).alias("surname")), "people")
    # a title that tells no gender: what other titles say of the person, or else of all who are called so
    told = people.filter("gender <> 'n' AND given IS NOT NULL")
    one = F.when(F.min("gender") == F.max("gender"), F.min("gender"))
    of_person = told.groupBy("given", "surname").agg(one.alias("g1"))
    of_given = told.groupBy("given").agg(one.alias("g2"))
    people = people.join(of_person, ["given", "surname"], "left").join(of_given, "given", "left")
    gender = F.when(F.col("gender") != "n", F.col("gender")).otherwise(F.coalesce("g1", "g2", F.lit("n")))
    surname = part(F.lit("surname"), F.col("surname"))
    parts = (F.when(F.col("given").isNull(), F.array(surname))
             .otherwise(F.array(part(F.concat(F.lit("given_"), gender), F.col("given")), surname)))
    return found.unionByName(people.select("entity", "kind", parts.alias("parts")))


def distinct_surrogates(parts: DataFrame, key: str) -> DataFrame:
    """kind, canon and surrogate for every distinct part; no surrogate equals
    another one or a real part."""
    now = persist(parts.select(F.inline("parts")).distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key)), "surrogates")
    real = now.select(F.col("canon").alias("surrogate")).distinct()
    for _ in range(MAX_ATTEMPTS):
        place = F.row_number().over(Window.partitionBy("surrogate").orderBy("attempt", "kind", "canon"))
        met = now.withColumn("place", place).join(real.withColumn("taken", F.lit(True)), "surrogate", "left")
        again = met.filter("place > 1 OR taken").select("kind", "canon", F.lit(1).alias("more"))
        again = persist(again, "met")
        if not again.limit(1).count():
            return now.select("kind", "canon", "surrogate")
        redrawn = now.join(again, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("more", F.lit(0)))
        now = persist(redrawn.select("kind", "canon", "attempt").withColumn("surrogate", _surrogate(key)), "surrogates")
    raise RuntimeError("surrogates still meet; the formats are too narrow")


def _rendered() -> Column:
    """The replacement in the form of the entity: ``new`` holds the parts."""
    e, kind, new = F.col("entity"), F.col("kind"), F.col("new")
    filled = F.aggregate(
        _chars(e), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
        lambda a, c: F.when(c.rlike("[+0-9A-Za-z]"), F.struct(F.concat(a.s, F.substring(new[0], a.k, F.lit(1))).alias("s"), (a.k + 1).alias("k")))
        .otherwise(F.struct(F.concat(a.s, c).alias("s"), a.k.alias("k"))), lambda a: a.s)
    title = F.regexp_extract(e, f"^{_TITLES}", 0)
    return (F.when(kind == "email", F.when((e == F.upper(e)) & (e != F.lower(e)), F.upper(new[0])).otherwise(new[0]))
            .when(kind == "ip", new[0]).when(kind == "ip6", _ip6_rendered(e, new[0]))
            .when(kind == "person", F.concat(title, F.array_join(_names_rendered(), " ")))
            .when(kind == "iban", F.upper(filled)).otherwise(filled))


def _names_rendered() -> Column:
    """The new given name and surname in the case of the entity."""
    all_caps = F.regexp_replace("entity", f"^{_TITLES}", "").rlike(r"^\P{Ll}+$")
    return F.transform("new", lambda s: F.when(all_caps, F.upper(s)).otherwise(F.initcap(s)))


def replacements(entities: DataFrame, key: str) -> DataFrame:
    """entity, kind, replacement and names (of a person: each name as written
    and its replacement) for distinct matches (column entity); a number that is
    no valid card is left out."""
    found = persist(_parts(entities), "parts")
    drawn = distinct_surrogates(found, key)
    one = found.select("entity", "kind", F.posexplode("parts").alias("i", "p"))
    one = one.join(drawn.withColumnsRenamed({"kind": "k", "canon": "c"}), (F.col("p.kind") == F.col("k")) & (F.col("p.canon") == F.col("c")))
    new = one.groupBy("entity", "kind").agg(F.array_sort(F.collect_list(F.struct("i", "surrogate"))).alias("new"))
    new = new.withColumn("new", F.col("new.surrogate"))
    written = F.split(F.regexp_replace("entity", f"^{_TITLES}", ""), " ")
    names = F.when(F.col("kind") == "person", F.arrays_zip(written.alias("name"), _names_rendered().alias("other")))
    return persist(new.select("entity", "kind", _rendered().alias("replacement"), names.alias("names")), "replacements")


def _known(word: Column, place: Column) -> Column:
    """Replacement of a word that is a name found before the given match."""
    return F.get(F.filter("names", lambda n: (n["name"] == word) & (n["i"] < place)), F.lit(0))["other"]


def pii_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with all entities replaced, n_entities, kinds (sorted
    kind:count, comma-joined) and n_mentions (names replaced where they stand
    alone) for every row."""
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.col("text").cast("string").alias("text"))
    matches = F.when(F.col("text").rlike(MAYBE), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    found = persist(docs.select("rid", F.posexplode(matches).alias("i", "entity")).distinct(), "entities")
    new = replacements(found.select("entity").distinct(), key)
    placed = found.join(new, "entity")
    rows = placed.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("i", "replacement"))).alias("new"),
                                     F.count("*").alias("n"))
    kinds = (placed.groupBy("rid", "kind").count().groupBy("rid")
             .agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "kind", "count"))), ",").alias("kinds")))
    # names by document, each from where it is first found
    names = (placed.filter("names IS NOT NULL").select("rid", "i", F.inline("names"))
             .groupBy("rid", "name").agg(F.min(F.struct("i", "other")).alias("first"))
             .groupBy("rid").agg(F.collect_list(F.struct("name", "first.i", "first.other")).alias("names")))
    rows = persist(rows.join(kinds, "rid").join(names, "rid", "left"), "replaced")
    # the broadcast is checked by entities, which make the size of a row
    size = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = docs.join(F.broadcast(rows) if size <= MAX_BROADCAST_ROWS else rows, "rid", "left")

    def renamed(piece: Column, place: Column) -> Column:
        gaps, words = F.split(piece, MENTION, -1), F.regexp_extract_all(piece, F.lit(MENTION), F.lit(0))
        other = F.zip_with(gaps, words, lambda g, w: F.concat(g, F.coalesce(_known(w, place), w, F.lit(""))))
        return F.when(F.col("names").isNull(), piece).otherwise(F.array_join(other, ""))

    old = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    pieces = F.transform(F.split("text", PATTERN, -1), lambda p, i: F.struct(p.alias("p"), i.alias("i")))
    whole = F.zip_with(pieces, old, lambda x, o: F.concat(
        renamed(x["p"], x["i"]), F.coalesce(F.try_element_at("new", x["i"]), o, F.lit(""))))
    text = F.when(F.col("new").isNull(), F.col("text")).otherwise(F.array_join(whole, ""))
    alone = F.aggregate(pieces, F.lit(0), lambda a, x: a + F.size(F.filter(
        F.regexp_extract_all(x["p"], F.lit(MENTION), F.lit(0)), lambda w: _known(w, x["i"]).isNotNull())))
    return joined.select("doc_id", text.alias("text"), F.coalesce("n", F.lit(0)).cast("long").alias("n_entities"),
                         F.coalesce("kinds", F.lit("")).alias("kinds"),
                         F.when(F.col("names").isNull(), 0).otherwise(alone).cast("long").alias("n_mentions"))


def op4_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    return pii_surrogates(spark.read.parquet(f"{sf_dir}/documents.parquet"), key="starmart-surrogates-1")
