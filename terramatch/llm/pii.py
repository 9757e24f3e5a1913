"""Surrogate generation for personal data: keyed, type-consistent replacements that keep gender, script and format. DataFrame functions only."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, row_key, text_of

#: Titles that tell a gender, and those that don't.
MALE = "Mr\\.?|Mister|Herr|Monsieur|Señor|Г-н|Господин|Κύριος"
FEMALE = "Mrs\\.?|Ms\\.?|Miss|Frau|Madame|Mademoiselle|Señora|Señorita|Г-жа|Госпожа|Κυρία"
NEUTRAL = "Dr\\.?|Prof\\.?"
TITLE = f"(?:{MALE}|{FEMALE}|{NEUTRAL})"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Types of entities in the order in which they are tried at a place. Repeated groups have an upper bound (a domain has 127 labels at most): the engine
#: takes a frame of its stack for each turn of one.
PATTERNS = {
    "email": "(?<![\\p{L}0-9._%+-])[\\p{L}0-9._%+-]++@(?:[\\p{L}0-9-]++\\.){1,127}\\p{L}{2,}",
    "iban": "(?<![\\p{L}0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\\p{L}0-9])",
    "card": "(?<![\\p{L}0-9])(?:(?:[0-9]{4}[ -]?){3}[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![\\p{L}0-9])",
    "phone": "(?<![\\p{L}0-9+])(?:\\+[0-9]{1,3}[ .-]?)?(?:\\([0-9]{2,4}\\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3,4}[ .-][0-9]{4}|(?<=\\+[0-9]{1,3}[ .-]?)[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){2,4})(?![\\p{L}0-9])",
    "ssn": "(?<![\\p{L}0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\\p{L}0-9-])",
    "ip": f"(?<![\\p{{L}}0-9.]){OCTET}(?:\\.{OCTET}){{3}}(?!\\.?[0-9\\p{{L}}])",
    "person": f"(?<!\\p{{L}}){TITLE} \\p{{Lu}}\\p{{Ll}}+(?:[ -]\\p{{Lu}}\\p{{Ll}}+){{0,2}}",
}
ENTITY = "|".join(PATTERNS.values())
#: A text without any of these has no entity; the test costs little.
HINT = f"[0-9]{{2}}|@|[0-9]\\.[0-9]|(?:{TITLE}) "
#: Letters by script, lower case; fixed values. A letter is replaced by one of its own script and case.
SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {"latin": ("bdfgklmnprstv", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρσ", "αειοω")}
#: Endings of given names by script: of men, of women, of others.
ENDINGS = {"latin": ("n", "a", "e"), "cyrillic": ("н", "а", "е"), "greek": ("ς", "α", "ι")}
#: Rounds of drawing in the entity's own length; from then on each round draws one character more.
SAME_LENGTH = 4
#: Stands between the pieces of a text.
CUT = "\x01"


def script_of(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit("\\p{IsCyrillic}")), "cyrillic").when(F.rlike(text, F.lit("\\p{IsGreek}")), "greek").otherwise("latin")


def entity_type(entity: Column) -> Column:
    out = None
    for kind, pattern in PATTERNS.items():
        hit = F.rlike(entity, F.lit(f"^(?:{pattern})$"))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("person")


def _byte(bits: Column, i: Column) -> Column:
    """The i-th number below 256 of a string of 128 hexadecimal digits; it starts again after 64."""
    return F.conv(F.substring(bits, (2 * (i % 64) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _letter(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _name(bits: Column, script: str, gender: Column, length: Column) -> Column:
    """A name of syllables, and an ending that tells the gender; longer with each round of drawing."""
    consonants, vowels = SYLLABLES[script]
    syllable = lambda i: F.concat(_letter(consonants, _byte(bits, 2 * i)), _letter(vowels, _byte(bits, 2 * i + 1)))
    man, woman, other = ENDINGS[script]
    return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), length - 1), syllable), ""), F.when(gender == "m", man).when(gender == "f", woman).otherwise(other))


def _drawn(key: str, kind: Column, norm: Column, gender: Column, turn: int) -> tuple[Column, ...]:
    """A candidate in the norm's form. Digits become digits and letters become letters of their script; a card keeps its first digit,
    a phone number what precedes its last ten digits, an account number its country (and right check digits, where they were), an e-mail address its last label. After
    SAME_LENGTH rounds e-mail addresses get further letters in front and numbers further digits at their end, so a form whose
    candidates are all taken has ten times as many in the next round."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, norm, F.lit(str(turn)))
    bits = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("+")), 256))
    more = max(0, turn - SAME_LENGTH + 1)
    kept = F.when(kind == "card", 1).when(kind == "iban", 2).when(kind == "phone", F.greatest(F.length(norm) - 10, F.lit(0))).otherwise(0)
    base = F.when(kind == "email", F.concat(F.lit("a" * more), norm)).otherwise(F.concat(norm, F.lit("0" * more))) if more else norm
    until = F.when(kind == "email", F.length(base) - F.length(F.substring_index(norm, ".", -1))).otherwise(F.length(base))
    one = lambda c, i: F.when((i < kept) | (i >= until), c).when(F.rlike(c, F.lit("[0-9]")), (_byte(bits, i) % 10).cast("string")).when(F.rlike(c, F.lit("\\p{IsCyrillic}")), _letter(SCRIPTS["cyrillic"], _byte(bits, i))).when(F.rlike(c, F.lit("\\p{IsGreek}")), _letter(SCRIPTS["greek"], _byte(bits, i))).when(F.rlike(c, F.lit("\\p{L}")), _letter(SCRIPTS["latin"], _byte(bits, i))).otherwise(c)
    spelt = F.array_join(F.transform(F.split(base, ""), one), "")
    # four numbers of an address; where those give out, an address of the next version for documentation
    octets = F.concat_ws(".", *[(_byte(bits, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]) if turn < 2 * SAME_LENGTH else F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.substring(bits, 4 * i + 1, 4) for i in range(6)]))
    script, size = script_of(norm), F.lit(2 + turn) + F.when(F.length(norm) > 5, 1).otherwise(0)
    name = F.when(script == "cyrillic", _name(bits, "cyrillic", gender, size)).when(script == "greek", _name(bits, "greek", gender, size)).otherwise(_name(bits, "latin", gender, size))
    # the last digit of a card number that passes Luhn's test is chosen so that its replacement does too
    digits = lambda x: F.reverse(F.filter(F.split(x, ""), lambda c: c != ""))
    luhn = lambda x: F.aggregate(F.transform(digits(x), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - 9 * (c.cast("int") > 4).cast("int"))), F.lit(0), lambda a, b: a + b) % 10
    head = F.expr("substring(spelt, 1, length(spelt) - 1)")
    # and so are the two check digits of an account number that passes its test
    remainder = lambda x: F.aggregate(F.filter(F.split(x, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(F.rlike(c, F.lit("[0-9]")), (a * 10 + F.conv(c, 36, 10).cast("int")) % 97).otherwise((a * 100 + F.conv(c, 36, 10).cast("int")) % 97))
    country, account = F.substring("spelt", 1, 2), F.expr("substring(spelt, 5)")
    iban = F.when(F.col("mod97") == 1, F.concat(country, F.lpad((98 - remainder(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)).otherwise(F.col("spelt"))
    card = F.when(F.col("luhn") == 0, F.concat(head, ((10 - luhn(F.concat(head, F.lit("0")))) % 10).cast("string"))).otherwise(F.col("spelt"))
    return spelt, octets, name, card, iban, luhn(norm), remainder(F.concat(F.expr("substring(norm, 5)"), F.substring("norm", 1, 4)))


def _candidates(left: DataFrame, key: str, turn: int) -> DataFrame:
    kind = F.col("kind")
    spelt, octets, name, card, iban, luhn, mod97 = _drawn(key, kind, F.col("norm"), F.col("gender"), turn)
    drawn = left.withColumn("spelt", F.when(kind.isin("ip", "person"), F.lit("")).otherwise(spelt)).withColumns({"luhn": F.when(kind == "card", luhn), "mod97": F.when(kind == "iban", mod97)})
    return drawn.withColumn("surrogate", F.when(kind == "ip", octets).when(kind == "person", name).when(kind == "card", card).when(kind == "iban", iban).otherwise(F.col("spelt"))).drop("spelt", "luhn", "mod97")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm, surrogate for distinct entities (kind, norm, gender).

    Within a kind no two entities share a replacement and none is a real entity of the corpus. An entity whose candidate is taken
    draws again; of several with one candidate the least keeps it. Each round is a join of the entity table with itself on the
    candidates, and only the entities that lost go on, so rounds shrink fast. After a few rounds each one has at least ten times the
    candidates of the one before, so rounds end however few a form has.
    """
    # one gender an entity, so that a word has one replacement wherever it stands
    left = durable(entities.groupBy("kind", "norm").agg(F.min("gender").alias("gender")), "entities")
    real, done = left.select("kind", F.col("norm").alias("surrogate")), None
    for turn in count():
        drawn = _candidates(left, key, turn)
        best = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        won = durable(best.join(taken, ["kind", "surrogate"], "left_anti"), "surrogates")
        done = won if done is None else done.unionByName(won)
        left = durable(left.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti"), "entities")
        if left.isEmpty():
            break
    return done.select("kind", "norm", "surrogate")


def _norm(kind: Column, entity: Column) -> Column:
    """What two spellings of one entity have in common."""
    return F.when(kind.isin("card", "phone", "ssn", "iban"), F.lower(F.regexp_replace(entity, "[^\\p{L}0-9]", ""))).otherwise(F.lower(entity))


def _spelt_as(entity: Column, plain: Column) -> Column:
    """plain's characters in the places of entity's letters and digits, each in the case of the one whose place it takes; what plain has
    more of at the end."""
    bare = lambda x: F.regexp_replace(x, "[^\\p{L}0-9]", "")
    at = lambda i: F.length(bare(F.substring(entity, F.lit(1), (i + 1).cast("int"))))
    new = lambda c, i: F.when(~F.rlike(c, F.lit("[\\p{L}0-9]")), c).when(F.rlike(c, F.lit("\\p{Lu}")), F.upper(F.substring(plain, at(i), F.lit(1)))).otherwise(F.substring(plain, at(i), F.lit(1)))
    return F.concat(F.array_join(F.transform(F.split(entity, ""), new), ""), F.substring(plain, F.length(bare(entity)) + 1, F.length(plain)))


def _mail_as(entity: Column, plain: Column) -> Column:
    """plain in the case of entity; what plain has more of stands in front."""
    more = F.length(plain) - F.length(entity)
    new = lambda c, i: F.when(F.rlike(c, F.lit("\\p{Lu}")), F.upper(F.substring(plain, (more + i + 1).cast("int"), F.lit(1)))).otherwise(F.substring(plain, (more + i + 1).cast("int"), F.lit(1)))
    return F.concat(F.substring(plain, F.lit(1), more), F.array_join(F.transform(F.split(entity, ""), new), ""))


def _cased(word: Column, like: Column) -> Column:
    return F.when(F.rlike(like, F.lit("^\\p{Lu}")), F.concat(F.upper(F.substring(word, 1, 1)), F.expr("substring(surrogate, 2)"))).otherwise(word)


def _pieces(text: Column) -> Column:
    """The text cut at its entities: text and entity in turn, an entity at each second place. One pass of the expression."""
    marked = F.split(F.regexp_replace(text, f"({ENTITY})", f"{CUT}$1{CUT}"), CUT, -1)
    found, gaps = F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(1)), F.split(text, f"(?:{ENTITY})", -1)
    by_parts = F.slice(F.flatten(F.transform(gaps, lambda g, i: F.array(g, F.coalesce(F.get(found, i), F.lit(""))))), F.lit(1), 2 * F.size(gaps) - 1)
    return F.when(F.contains(text, F.lit(CUT)), by_parts).otherwise(marked)


#: A capitalised word, as names are.
NAME = "\\p{Lu}\\p{Ll}+(?!\\p{L})"


def _titled(piece: Column) -> Column:
    return F.rlike(piece, F.lit(f"^{TITLE} "))


def _with_names(hits: DataFrame) -> DataFrame:
    """hits (key, pieces, ...) with pieces also cut at the words of the text's own persons wherever else they stand: who has once been named with a
    title is replaced without one too.

    Only texts with a titled person take part. Their other pieces are cut before each capitalised word, these words meet the text's names in a join, and
    the pieces are put together again with marks: work and memory grow with a text and its names, not with their product. A text that holds the
    mark itself is left with its titled names."""
    some = F.exists("pieces", lambda x: _titled(x)) & ~F.exists("pieces", lambda x: F.contains(x, F.lit(CUT)))
    of_texts = durable(hits.filter(some).select("key", "pieces").dropDuplicates(["key"]), "pii-persons").select("key", F.posexplode("pieces").alias("at", "piece"))
    names = of_texts.filter((F.col("at") % 2 == 1) & _titled(F.col("piece")))
    names = names.select("key", F.explode(F.split(F.regexp_replace("piece", f"^{TITLE} ", ""), "[ -]")).alias("name")).filter(F.length("name") > 1).distinct()
    chunks = of_texts.filter("at % 2 = 0").select("key", "at", F.posexplode(F.split("piece", f"(?<!\\p{{L}})(?={NAME})")).alias("n", "chunk"))
    chunks = chunks.withColumn("word", F.regexp_extract("chunk", f"^{NAME}", 0))
    marked = F.when(F.col("name").isNotNull(), F.concat(F.lit(CUT), "word", F.lit(CUT), F.expr("substring(chunk, length(word) + 1)"))).otherwise(F.col("chunk"))
    together = lambda at, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, what))), lambda x: x[what]), "")
    met = chunks.join(names.select(F.col("key").alias("of"), "name"), (F.col("key") == F.col("of")) & (F.col("word") == F.col("name")), "left")
    even = met.withColumn("marked", marked).groupBy("key", "at").agg(together("n", "marked").alias("piece"))
    odd = of_texts.filter("at % 2 = 1").select("key", "at", F.concat(F.lit(CUT), "piece", F.lit(CUT)).alias("piece"))
    cut = even.unionByName(odd).groupBy("key").agg(F.split(together("at", "piece"), CUT, -1).alias("cut"))
    again = durable(hits.filter(some).join(cut, "key").withColumn("pieces", F.col("cut")).drop("cut"), "pii-named")
    return hits.filter(~some).unionByName(again.select(*hits.columns))


def replace_pii(docs: DataFrame, *, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text's entities replaced, and n_entities. All columns of docs stay, but for an own n_entities.

    Detected: e-mail addresses, bank accounts, cards of 15 and 16 digits, phone numbers, social-security numbers, IPv4 addresses, and names
    after a title with all further places of their words in the same text. Not detected: names that have no title anywhere in the
    text, postal addresses, IPv6 addresses.

    Detection is one regular expression over texts that have a digit or another hint, run once. Names of persons are replaced word by
    word, so that a surname alone gets the replacement that it has next to a given name; the first of several words is a given name
    and shows the title's gender. Replacements depend on the key, the type and the entity, and on which candidates other entities
    hold, and so agree in all documents and in all runs over one corpus.

    Scale: rows are written once with what was found in them; texts without an entity then pass by and never move. Entities are made
    distinct before they draw. Texts with entities meet their replacements, in order of place, in one join.

    An e-mail address has at most 127 labels after its sign; of a longer one the front counts. No expression repeats a group without bound, so long texts
    take time in proportion to their length.

    Defined results: a null text stays null and an empty one empty, both with 0 entities; equal texts become equal texts; null ids and
    repeated rows make no difference; an empty table gives an empty one.
    """
    text = text_of(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.when(F.rlike(text, F.lit(HINT)), _pieces(text)).alias("pieces"))
    rows = durable(rows.withColumn("pieces", F.when(F.size("pieces") > 1, F.col("pieces"))), "pii-found")
    hits = _with_names(rows.filter("pieces IS NOT NULL").withColumn("key", row_key(F.array_join("pieces", ""))))
    places = hits.select("key", "pieces").dropDuplicates(["key"]).select("key", F.posexplode("pieces").alias("at", "entity")).filter("at % 2 = 1")
    # a person's words; any other entity is one word
    words = places.withColumn("kind", entity_type(F.col("entity"))).withColumn("title", F.when(F.col("kind") == "person", F.regexp_extract("entity", f"^{TITLE} ", 0)).otherwise(F.lit("")))
    words = words.withColumn("body", F.expr("substring(entity, length(title) + 1)")).withColumn("words", F.when(F.col("kind") == "person", F.split("body", "(?<=[ -])|(?=[ -])")).otherwise(F.array("body")))
    words = words.select("key", "at", "kind", "title", F.size("words").alias("n"), F.posexplode("words").alias("part", "word"))
    gender = F.when((F.col("n") > 1) & (F.col("part") == 0), F.when(F.rlike("title", F.lit(f"^(?:{FEMALE}) ")), "f").when(F.rlike("title", F.lit(f"^(?:{MALE}) ")), "m").otherwise("n")).otherwise("s")
    words = durable(words.withColumn("gender", gender).withColumn("norm", _norm(F.col("kind"), F.col("word"))), "pii-words")
    replaced = F.rlike("word", F.lit("[\\p{L}0-9]"))
    table = surrogates(words.filter(replaced).select("kind", "norm", "gender"), key)
    plain = F.col("surrogate")
    new = F.when(plain.isNull(), F.col("word")).when(F.col("kind") == "person", _cased(plain, F.col("word"))).when(F.col("kind").isin("card", "phone", "ssn", "iban"), _spelt_as(F.col("word"), plain)).when(F.col("kind") == "email", _mail_as(F.col("word"), plain)).otherwise(plain)
    made = words.join(table, ["kind", "norm"], "left").select("key", "at", "title", "part", new.alias("new"))
    made = made.groupBy("key", "at").agg(F.concat(F.first("title"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "new"))), lambda x: x["new"]), "")).alias("new"))
    made = durable(made.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("new")), "pii-new")
    whole = F.array_join(F.transform("pieces", lambda x, i: F.when(i % 2 == 0, x).otherwise(F.get(F.col("new"), F.floor(i / 2).cast("int")))), "")
    spliced = hits.join(made, "key").select("row", whole.alias("text"), F.size("new").cast("long").alias("n_entities"))
    out = spliced.unionByName(rows.filter("pieces IS NULL").select("row", F.col(f"row.`{text_col}`").cast("string").alias("text"), F.lit(0).cast("long").alias("n_entities")))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "n_entities"], "n_entities")
