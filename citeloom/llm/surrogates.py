"""Personal data replaced by surrogates, with DataFrame functions only.

Detected: e-mail addresses, IPv4 and IPv6 addresses, phone, card, social security and account numbers, access keys of
known prefixes, values after password=, token= and the like, and names after a title.  Phone numbers are 7 to 15 digits
after +, 00 or 0 in any groups, and without such a lead the groups 3-3-4 and 3-2-2-2; cards are 16 digits in fours, and
13 to 19 digits unbroken or in usual groups if their checksum is right.

Not detected: phone numbers without lead in other groups or unbroken, those in the form of a date and those with letters;
cards in unusual groups; names without a title, of more than two words, with particles (von, de la), or after a title in
other case; street addresses, dates of birth, private key blocks, and keys of other prefixes without a lead.  A number
right after a phone number with a lead, apart by a space only, may be taken as a part of it.

Every different entity (its kind and normal form, so that
mentions that differ in case, spaces or punctuation are one) gets a surrogate drawn by a keyed hash.  A check over all
entities of the corpus draws again where two entities of a kind have the same surrogate or a surrogate is itself an
entity found, until all are distinct.  Names are drawn and checked word by word, surnames apart from given names of men
and of women, and put together from these: a surname has one surrogate in the corpus, whatever stands before it.  Each mention is then rewritten in its own format: digits stand where its digits
stood, cards keep their checksum's validity, names keep script and the gender of the title.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.shared import stored

#: The Spark setting of the key for `session_key`.
KEY_SETTING = "spark.citeloom.surrogates.key"
#: Syllables of a name before its ending, one more at each further attempt: 4 * 16**4 names of a kind at the first.
NAME_SYLLABLES = 4

# fixed values: titles by gender
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Don", "Sir")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Mlle", "Mademoiselle", "Fräulein", "Señorita", "Srta", "Doña", "Dra", "Doctora", "Profesora")
NEUTRAL = ("Dr", "Doctor", "Docteur", "Doktor", "Prof", "Professor", "Professeur", "Profesor")
# fixed values: syllables and endings of invented names
SYLLABLES = {
    "latin": "ba be do fa ga ka la le ma mi na no ra ri sa ta".split(),
    "cyrillic": "ба ве до га ка ла ле ма ми на но ра ри са та ви".split(),
    "greek": "βα γε δο κα λα λε μα μι να νο ρα ρι σα τα φι χα".split(),
}
ENDINGS = {
    ("latin", "m"): "n s rt ld".split(), ("latin", "f"): "na ra la tte".split(), ("latin", "s"): "ner lin son der".split(),
    ("latin", "n"): "el is o ay".split(), ("cyrillic", "n"): "ель ис о ай".split(), ("greek", "n"): "ελ ις ο αι".split(),
    ("cyrillic", "m"): "н р с т".split(), ("cyrillic", "f"): "на ра ля ня".split(), ("cyrillic", "s"): "нов рин цев лин".split(),
    ("greek", "m"): "ς ος ης ας".split(), ("greek", "f"): "να ρα λη νη".split(), ("greek", "s"): "δης ρος λης νος".split(),
}

_LABEL = r"[\p{L}\p{N}-]"
#: A group that repeats without bound is possessive: any other takes a frame of the stack at each turn.  A domain of any
#: length is taken whole if its last label has letters only, else as far as a label of letters, of which 128 are looked at.
_EMAIL = (
    rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]{{1,64}}+@"
    rf"(?:{_LABEL}++(?:\.{_LABEL}++)*+(?<=\.\p{{L}}{{2,63}})|{_LABEL}+(?:\.{_LABEL}+){{0,126}}\.\p{{L}}{{2,}})"
)
_IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
_V4 = r"(?:\d{1,3}\.){3}\d{1,3}"
_HEX = "[0-9A-Fa-f]{1,4}"
_IPV6 = (
    rf"(?<![\w:.])(?=[0-9A-Fa-f:.]{{0,45}}\d)(?:(?:{_HEX}:){{6}}(?:{_HEX}:{_HEX}|{_V4})"
    rf"|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:(?:{_HEX}:){{0,5}}(?:{_V4}|{_HEX}))?)(?![\w:]|\.\d)"
)
#: One more digit of a phone number, in any grouping; an IPv4 address behind a space is none of it.
_DIGIT = rf"(?:(?:\.|[ .\-/()\u00a0\u202f]{{1,2}}(?!{_V4}(?!\d)))\d|\d)"
#: What follows the first 0 of a date.
_DATE = r"\d[./-]\d{1,2}[./-](?:\d{4}|\d{2})(?![\d./ -]{0,2}\d)"
#: Further groups of a number written in thousands, up to six more (a chain without end would be read again at each group).
_THOUSANDS = r"(?<=\d )\d{3}(?: \d{3}){1,6}(?! ?\d)"
_PHONE = (
    r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}(?![ .-]?\d)"
    r"|(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
    rf"|(?:(?<![\p{{L}}\d+])\+|(?<![\p{{L}}\d.,_+/-])00)\(?[1-9]{_DIGIT}{{6,14}}(?![\p{{L}}\d])"
    rf"|(?<![\p{{L}}\d.,_+/(-])\(?(?!{_THOUSANDS})0(?!{_DATE})(?=[1-9]){_DIGIT}{{7,14}}(?![\p{{L}}\d])"
    r"|(?<![\p{L}\d.,_+/-])(?<!\d )(?:\d{3}\.\d{3}\.\d{4}|\d{3} \d{3} \d{4}|[6-9]\d{2} \d{2} \d{2} \d{2})(?![\p{L}\d]|[., -]\d)"
)
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_CARD = r"(?<!\d)\d{4}(?:[ -]?\d{4}){3}(?!\d)"
#: Only with a right checksum; 16 digits in fours are a card in any case.
_LONG_CARD = (
    r"(?<!\d)(?<!\d[.,])(?:\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{4}(?:[ -]\d{3}){3}|\d{13,19})(?!\d)"
)
_KEY_LEAD = (
    r"(?:ASIA|gh[pousr]_|github_pat_|glpat-|npm_|hf_|sk-|[spr]k_(?:live|test)_|AIza|xox[abeprs]-|ya29\.|SG\.|eyJ)"
)
_KEY = rf"(?<![A-Za-z0-9_-])(?=[AESghnspraxy]){_KEY_LEAD}[A-Za-z0-9_-]{{16,}}+(?:\.[A-Za-z0-9_-]++)*+"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_ACCESS = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
_SECRET_LEAD = r"""(?i:(?<!\p{L})(?:token|password|passwd|pwd|secret|api[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?)"""
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_TITLE = rf"(?:{'|'.join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))})\.?"
_PERSON = rf"(?<!\p{{L}}){_TITLE} (?:{_TITLE} ){{0,3}}{_NAME}(?: {_NAME})?(?!\p{{L}})"
_INITIALS = "".join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL}))
PATTERN = (
    rf"(?=[0-9A-Fa-f:]){_IPV6}|(?=[\d+(])(?:{_IP}|{_PHONE}|{_SSN}|{_LONG_CARD}|{_CARD})|(?=[A-Z])(?:{_ACCESS}|{_IBAN})"
    rf"|(?=[tpsaTPSA]){_SECRET_LEAD}[^\s\"']{{6,}}|{_KEY}|(?=[{_INITIALS}]){_PERSON}|{_EMAIL}"
)


#: A card in fours with a few digits behind it, which are its own only if the checksum says so.
_FOURS = r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}$"


def _right_card(mention: Column) -> Column:
    return _checksum(F.regexp_replace(mention, "[^0-9]", "")) == 0


def _kind(mention: Column) -> Column:
    return (
        F.when(mention.rlike(rf"^(?:{_EMAIL})$"), "email")
        .when(mention.rlike(rf"^(?:{_IPV6})$"), "ipv6")
        .when(mention.rlike(rf"^(?:{_IP})$"), "ip")
        .when(mention.rlike(rf"^(?:{_SSN})$"), "ssn")
        .when(mention.rlike(rf"^(?:{_CARD})$"), "card")
        .when(mention.rlike(rf"^(?:{_PHONE})$"), "phone")
        .when(mention.rlike(rf"^(?:{_LONG_CARD})$"), F.when(mention.rlike(_FOURS) | _right_card(mention), "card").otherwise("none"))
        .when(mention.rlike(rf"^(?:{_PERSON})$"), "person")
        .when(mention.rlike(rf"^(?:{_ACCESS}|{_IBAN})$"), "account")
        .otherwise("secret")
    )


def _split_mention(kind: Column, mention: Column) -> Column:
    """What stays before the entity, the entity as it is written, and what stays behind it."""
    lead = (
        F.when(kind == "secret", F.regexp_extract(mention, rf"^((?:{_SECRET_LEAD})?(?:{_KEY_LEAD})?)", 1))
        .when(kind == "person", F.regexp_extract(mention, rf"^({_TITLE} (?:{_TITLE} (?=\p{{Lu}})){{0,3}})", 1))
        .when((kind == "phone") & mention.startswith("+"), F.regexp_extract(mention, r"^(\+\d)", 1))
        .when((kind == "account") & mention.startswith("AKIA"), F.lit("AKIA"))
        .when(kind == "account", F.substring(mention, 1, 2))
        .otherwise("")
    )
    tail = F.when((kind == "card") & mention.rlike(_FOURS) & ~_right_card(mention), F.substring(mention, 20, 4)).otherwise("")
    own = F.substring(mention, F.length(lead) + 1, F.length(mention) - F.length(lead) - F.length(tail))
    return F.struct(lead.alias("lead"), own.alias("own"), tail.alias("tail"))


def _groups(address: Column) -> Column:
    """An IPv6 address in small letters, all its groups without leading zeros."""
    left, right = (F.filter(F.split(F.substring_index(address, "::", k), ":"), lambda g: g != "") for k in (1, -1))
    width = F.size(left) + F.size(right) + F.when(address.contains("."), 1).otherwise(0)
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - width, F.lit(0)))
    groups = F.when(address.contains("::"), F.concat(left, zeros, right)).otherwise(F.split(address, ":"))
    return F.lower(F.concat_ws(":", F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", ""))))


def _normal(kind: Column, lead: Column, own: Column) -> Column:
    """The form that mentions of one entity share; what stays takes part where it tells entities apart."""
    male, female = (rf"(?<!\p{{L}})(?:{'|'.join(t)})(?!\p{{L}})" for t in (MALE, FEMALE))
    gender = F.when(lead.rlike(female), "f").when(lead.rlike(male), "m").otherwise("n")
    return (
        F.when(kind == "email", F.lower(own))
        .when(kind == "ipv6", _groups(own))
        .when(kind.isin("phone", "ssn", "card"), F.concat(F.regexp_replace(lead, "[^0-9]", ""), F.regexp_replace(own, "[^0-9]", "")))
        .when(kind == "account", F.concat(lead, F.regexp_replace(own, " ", "")))
        .when(kind == "person", F.concat_ws("|", gender, F.lower(own)))
        .otherwise(own)
    )


def _number(stream: Column, i: Column | int, below: int) -> Column:
    """The i-th number of a stream of hexadecimal digits, of 64 positions that recur."""
    at = (F.lit(i) if isinstance(i, int) else i) % 64
    return F.conv(F.substring(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int") % below


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), number + 1)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _shaped(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Each digit, letter and capital replaced by one of its kind; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        n = _number(stream, i, 256)
        return (
            F.when(hexadecimal & c.rlike("[0-9a-f]"), F.lower(F.hex((n % 16).cast("bigint"))))
            .when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(n % 26 + 97))
            .when(c.rlike("[A-Z]"), F.char(n % 26 + 65))
            .when(c.rlike(r"\p{IsCyrillic}"), _pick(SYLLABLES["cyrillic"], n % 16).substr(1, 1))
            .when(c.rlike(r"\p{IsGreek}"), _pick(SYLLABLES["greek"], n % 16).substr(1, 1))
            .when(c.rlike(r"\p{L}"), F.char(n % 26 + 97))
            .otherwise(c)
        )

    return F.concat_ws("", F.transform(F.split(text, ""), one))


def _checksum(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    def add(total: Column, x: Column) -> Column:
        d = x["d"] * F.when(x["i"] % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    backwards = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(backwards, F.lit(0), add) % 10


def _card(normal: Column, stream: Column) -> Column:
    """Digits whose checksum is right if the original's is, and wrong otherwise."""
    body = F.substring(_shaped(normal, stream, F.lit(False)), F.lit(1), F.length(normal) - 1)
    last = (10 - _checksum(F.concat(body, F.lit("0")))) % 10
    return F.concat(body, ((last + F.when(_checksum(normal) == 0, 0).otherwise(1)) % 10).cast("string"))


#: Kinds of words of names, and which endings theirs are.
NAME_KINDS = {"surname": "s", "given-m": "m", "given-f": "f", "given-n": "n"}


def _name(kind: str, stream: Column, script: Column, attempt: Column) -> Column:
    def of(s: str) -> Column:
        length = F.lit(NAME_SYLLABLES) + attempt
        stem = F.concat_ws("", F.transform(F.sequence(F.lit(1), length), lambda i: _pick(SYLLABLES[s], _number(stream, i, 16))))
        return F.initcap(F.concat(stem, _pick(ENDINGS[s, kind], _number(stream, 0, 4))))

    return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))


def _stream(key: str, *parts: Column) -> Column:
    text = F.concat_ws("\x1f", F.lit(key), *parts)
    return F.concat(F.sha2(F.concat(text, F.lit("\x1f0")), 256), F.sha2(F.concat(text, F.lit("\x1f1")), 256))


def surrogate(kind: Column, normal: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity in its normal form."""
    stream = _stream(key, kind, normal, attempt.cast("string"))
    hexadecimal = normal.rlike("^[0-9a-f]+$")
    local = F.substring_index(normal, "@", 1)
    octets = F.concat_ws(".", *((_number(stream, i, 254) + 1).cast("string") for i in range(4)))
    script = _script(normal)
    names = {k: F.lower(_name(ending, stream, script, attempt)) for k, ending in NAME_KINDS.items()}

    return (
        F.when(kind == "email", F.concat(_shaped(local, stream, F.lit(False)), F.lit("@"), _shaped(F.lit("mail"), F.substring(stream, F.lit(65), F.lit(64)), F.lit(False)), F.lit(".example.org")))
        .when(kind == "ip", octets)
        .when(kind == "ipv6", F.concat_ws(":", F.lit("2001:db8"), *(F.substring(stream, 4 * i + 1, 4) for i in range(6))))
        .when(kind == "card", _card(normal, stream))
        .when(kind == "phone", F.concat(F.substring(normal, 1, 1), _shaped(F.substring(normal, F.lit(2), F.length(normal)), stream, F.lit(False))))
        .when(kind == "ssn", _shaped(normal, stream, F.lit(False)))
        .when(kind == "surname", names["surname"])
        .when(kind == "given-m", names["given-m"])
        .when(kind == "given-f", names["given-f"])
        .when(kind == "given-n", names["given-n"])
        .when(kind == "account", _account(normal, stream))
        .otherwise(_shaped(normal, stream, hexadecimal))
    )


def _account(normal: Column, stream: Column) -> Column:
    keep = F.when(normal.startswith("AKIA"), 4).otherwise(2)
    return F.concat(F.substring(normal, F.lit(1), keep), _shaped(F.substring(normal, keep + 1, F.length(normal)), stream, F.lit(False)))


def _realm(kind: Column) -> Column:
    """Kinds whose entities no surrogate of the kind may be: a word of a name may be no word of any name found."""
    return F.when(kind.isin(*NAME_KINDS), "name").otherwise(kind)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, normal and surrogate of different entities (kind, normal), all surrogates of a kind distinct and new."""
    now = entities.select("kind", "normal", F.lit(0).alias("attempt"))
    while True:
        drawn = now.withColumn("surrogate", surrogate(F.col("kind"), F.col("normal"), F.col("attempt"), key))
        winners = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "normal")).alias("first"))
        real = entities.select(_realm(F.col("kind")).alias("realm"), F.col("normal").alias("surrogate")).distinct()
        judged = drawn.join(winners, ["kind", "surrogate"]).withColumn("realm", _realm(F.col("kind")))
        judged = judged.join(real.withColumn("real", F.lit(True)), ["realm", "surrogate"], "left")
        bad = (F.col("first.normal") != F.col("normal")) | F.col("real").isNotNull()
        judged = stored(judged.select("kind", "normal", "attempt", "surrogate", bad.alias("bad")), "surrogates")
        if judged.where("bad").isEmpty():
            return judged.select("kind", "normal", "surrogate")
        now = judged.select("kind", "normal", (F.col("attempt") + F.col("bad").cast("int")).alias("attempt"))


def _name_words(persons: DataFrame) -> DataFrame:
    """normal (of the person), pos, kind and word of the words of different persons: the last is the surname.

    A given name after a title without gender is that of a woman or else of a man where the corpus has it so.
    """
    words = F.split(F.substring("normal", 3, 1 << 20), " ")
    rows = persons.select("normal", F.size(words).alias("size"), F.posexplode(words).alias("pos", "word"))
    rows = rows.withColumn("gender", F.substring("normal", 1, 1))
    known = rows.where("pos < size - 1 AND gender <> 'n'").groupBy("word").agg(F.min("gender").alias("known"))
    rows = rows.join(known, "word", "left")
    gender = F.when(F.col("gender") == "n", F.coalesce("known", "gender")).otherwise(F.col("gender"))
    kind = F.when(F.col("pos") == F.col("size") - 1, "surname").otherwise(F.concat(F.lit("given-"), gender))
    return rows.select("normal", "pos", kind.alias("kind"), "word")


def assign_all(entities: DataFrame, key: str) -> DataFrame:
    """kind, normal and surrogate of different entities (kind, normal); persons are put together from their words."""
    words = stored(_name_words(entities.where("kind = 'person'")), "name-words")
    others = entities.where("kind <> 'person'").select("kind", "normal")
    single = stored(others.unionByName(words.select("kind", F.col("word").alias("normal")).distinct()), "single-entities")
    chosen = assign(single, key)
    own = words.join(chosen.withColumnRenamed("normal", "word"), ["kind", "word"])
    own = own.groupBy("normal").agg(F.sort_array(F.collect_list(F.struct("pos", "surrogate"))).alias("w"))
    name = F.concat(F.substring("normal", 1, 2), F.concat_ws(" ", F.transform("w", lambda x: x["surrogate"])))
    persons = own.select(F.lit("person").alias("kind"), "normal", name.alias("surrogate"))
    return chosen.where(~F.col("kind").isin(*NAME_KINDS)).unionByName(persons)


def _written(kind: Column, lead: Column, own: Column, new: Column) -> Column:
    """A surrogate in the format of a mention."""
    def fill(values: Column) -> Column:
        """Each letter or digit of the mention in turn becomes the next of values."""
        def one(c: Column, i: Column) -> Column:
            before = F.length(F.regexp_replace(F.substring(own, F.lit(1), i), "[^0-9A-Za-z]", ""))
            return F.when(c.rlike("[0-9A-Za-z]"), F.substring(values, before + 1, F.lit(1))).otherwise(c)

        return F.concat_ws("", F.transform(F.split(own, ""), one))

    kept = F.when(kind == "account", F.length(lead)).otherwise(F.length(F.regexp_replace(lead, "[^0-9]", "")))
    tail = F.substring(new, kept + 1, F.length(new))
    name = F.substring(new, F.lit(3), F.length(new))
    text = (
        F.when(kind.isin("phone", "ssn", "card", "account"), fill(tail))
        .when(kind == "person", F.when(own == F.upper(own), F.upper(name)).otherwise(F.initcap(name)))
        .when(kind.isin("email", "ipv6") & (own == F.upper(own)), F.upper(new))
        .otherwise(new)
    )
    return F.concat(lead, text)


_drawn: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """The key that the setting names, or else one drawn at random for this application: keys are secrets, none is built in."""
    key = spark.conf.get(KEY_SETTING, None)
    return key or _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows of docs, text with all detected entities replaced; n_entities is added unless docs has that column.

    Who has the key can tell which surrogate stands for a given entity; the same key gives the same surrogates.
    Null and empty texts and texts without entities stay as they are; repeated rows get the same surrogates; all other
    columns pass through.
    """
    found = F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(PATTERN), F.lit(0))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).withColumn("found", found)
    clean = rows.where(F.coalesce(F.size("found"), F.lit(0)) <= 0).select("row", F.lit(0).alias("n"))
    marked = rows.where(F.size("found") > 0).withColumn("gaps", F.split(f"row.`{text_col}`", PATTERN, -1))
    marked = stored(marked.withColumn("uid", F.monotonically_increasing_id()), "marked-documents")
    mentions = marked.select("uid", F.posexplode("found").alias("pos", "mention")).withColumn("kind", _kind(F.col("mention")))
    mentions = mentions.withColumn("m", _split_mention(F.col("kind"), F.col("mention"))).select(
        "uid", "pos", "kind", "mention", "m.lead", "m.own", "m.tail"
    )
    mentions = mentions.withColumn("normal", _normal(F.col("kind"), F.col("lead"), F.col("own")))
    kept = mentions.where("kind = 'none'").select("uid", F.struct("pos", F.col("mention").alias("text")).alias("w"), F.lit(0).alias("real"))
    mentions = mentions.where("kind <> 'none'")
    chosen = assign_all(stored(mentions.select("kind", "normal").distinct(), "entities"), key)
    new_text = _written(F.col("kind"), F.col("lead"), F.col("own"), F.col("surrogate"))
    written = mentions.join(chosen, ["kind", "normal"]).select(
        "uid", F.struct("pos", F.concat(new_text, "tail").alias("text")).alias("w"), F.lit(1).alias("real")
    )
    own = written.unionByName(kept).groupBy("uid").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("real").cast("int").alias("n"))
    joined = marked.join(own, "uid")
    parts = F.zip_with("gaps", F.transform("w", lambda x: x["text"]), lambda g, t: F.concat(g, F.coalesce(t, F.lit(""))))
    changed = joined.select("row", "n", F.concat_ws("", parts).alias("new"))
    new = [F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    extra = [] if "n_entities" in docs.columns else [F.col("n").alias("n_entities")]
    old = [F.col(f"row.`{c}`") for c in docs.columns]
    return clean.select(*old, *extra).unionByName(changed.select(*new, *extra))
