"""Text cleaning, name keys, similarity and prices."""

from pyspark.sql import Column, functions as F

# Words that say little about which lodging is meant; callers add the names of their region.
NAME_STOP_WORDS = ("hotel", "hostel", "homestay", "guesthouse", "villa", "resort", "inn")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Lower case, letters and digits only, single spaces."""
    kept = F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}\s]", "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def name_key(c, stop_words=NAME_STOP_WORDS) -> Column:
    """Distinct words of a name without the stop words, in alphabetical order."""
    words = F.array_except(F.split(clean_text(c), " "), F.array(*[F.lit(w) for w in stop_words]))
    return F.array_join(F.array_sort(words), " ")


def name_similarity(a, b, floor: float = 0.0) -> Column:
    """1 - edit distance / longer length. With a floor, pairs below it give null early."""
    a, b = _col(a), _col(b)
    longer = F.greatest(F.length(a), F.length(b))
    if floor <= 0.0:
        return F.when(longer == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longer)
    allowed = F.ceil(longer * F.lit(1.0 - floor)).cast("int")
    edits = F.call_function("levenshtein", a, b, allowed)
    similarity = F.when(longer == 0, F.lit(1.0)).when(edits >= 0, F.lit(1.0) - edits / longer)
    return F.when((similarity >= F.lit(floor)), similarity)


def amounts(c) -> Column:
    """Numbers in a price text. Groups of three after dots are thousands, as in `Rp 317.000`."""
    found = F.regexp_extract_all(_col(c), F.lit(r"[0-9]+(?:[.,][0-9]+)*"), F.lit(0))

    def number(x: Column) -> Column:
        dotted = x.rlike(r"^[0-9]{1,3}([.][0-9]{3})+(,[0-9]+)?$")
        commas = x.rlike(r"^[0-9]{1,3}(,[0-9]{3})+([.][0-9]+)?$")
        plain = (
            F.when(dotted, F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when(commas, F.replace(x, F.lit(","), F.lit("")))
            .otherwise(F.replace(x, F.lit(","), F.lit(".")))
        )
        return plain.try_cast("decimal(18,2)")

    return F.transform(found, number)


def currency_of(c, default: str = "IDR") -> Column:
    """Currency by the mark in a price text: `default` without any mark, null for one that is not known."""
    text = _col(c)
    nothing = F.lit(None).cast("string")
    # Currency marks, the longer ones first.
    marks = [
        (r"(?i)\bRp", "IDR"), (r"US\$", "USD"), (r"S\$", "SGD"), (r"A\$", "AUD"), (r"RM\s*[0-9]", "MYR"),
        ("€", "EUR"), ("£", "GBP"), ("¥", "JPY"), (r"(?<![A-Za-z])\$", "USD"),
    ]
    out = F.when(text.isNull(), nothing)
    for pattern, code in marks:
        out = out.when(text.rlike(pattern), F.lit(code))
    code = F.regexp_extract(text, r"(?:^|[^A-Za-z])([A-Z]{3})(?:\s*[0-9]|$)|[0-9]\s*([A-Z]{3})(?![A-Za-z])", 0)
    code = F.regexp_extract(code, "[A-Z]{3}", 0)
    return out.when(code != "", code).when(text.rlike(r"\p{Sc}"), nothing).otherwise(F.lit(default))


def tokens(c) -> Column:
    """Words of a text, cleaned; no empty words."""
    return F.filter(F.split(clean_text(c), " "), lambda w: w != "")
