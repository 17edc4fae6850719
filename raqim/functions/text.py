"""Text functions as column expressions: white space, cleaning, normal forms, summaries, quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space on the web, as one character class (valid for Java and RE2).
SPACE = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: Phrases of a redirect notice and of navigation that are no content.
REDIRECT = r"(?i)جاري التحويل\.{2,}[\t\n\x0B\f\r \x{A0}]*اضغط هنا إذا لم يتم التحويل تلقائياً"
NOISE = r"(?iu)^(الرئيسية|من نحن|اتصل بنا|سياس[ةه] الخصوصية|حقوق النشر|عرض المزيد|رسائل أقدم|social widget)$"
CHALLENGE = r"(?i)unusual traffic|not a robot|verify you are human|captcha|automatically detects requests"
DIACRITICS = r"[\x{0617}-\x{061A}\x{064B}-\x{0652}\x{0670}]"


def trim(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column, most: int = 0) -> Column:
    """Runs of white space as one space, trimmed, cut to ``most`` characters (0: uncut); null gives the empty string."""
    text = trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{SPACE}+", " "))
    return F.substring(text, 1, most) if most else text


def tidy(c: Column) -> Column:
    """No-break spaces as spaces, blanks collapsed, at most one blank line; null gives the empty string."""
    text = F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(" "))
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, f"{SPACE}*\\n{SPACE}*", "\n")
    return trim(text)


def strip_tags(c: Column, most: int = 0) -> Column:
    """``tidy`` without anything that looks like a tag, cut to ``most`` characters and trimmed again."""
    text = F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(" "))
    text = tidy(F.regexp_replace(text, r"<[^>]*>", " "))
    return trim(F.substring(text, 1, most)) if most else text


def searchable_parts(c: Column, signs: str) -> Column:
    """``searchable`` before white space is collapsed, with some ``signs`` left, so that all parts of a list get it at once; null stays."""
    text = F.regexp_replace(F.lower(c), DIACRITICS, "")
    text = F.translate(text, "أإآٱةۀىئؤ", "ااااههييو")
    return F.regexp_replace(text, rf"[^\x{{0600}}-\x{{06FF}}a-z0-9\t\n\x0B\f\r \x{{A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}{signs}]", " ")


def searchable(c: Column) -> Column:
    """The form in which keywords are compared: lower case, no vowel marks, letter variants unified, other signs as spaces."""
    return collapse(searchable_parts(F.coalesce(c, F.lit("")), ""))


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def without(text: Column, part: Column) -> Column:
    """All occurrences of ``part`` replaced by a space, where it isn't empty."""
    return _let(text, lambda x: F.when((part.isNotNull()) & (part != ""), collapse(F.replace(x, part, F.lit(" ")))).otherwise(x))


def summary(title: Column, description: Column, text: Column, most: int = 320) -> Column:
    """The text without redirect notice and title; else the description, else the title."""
    body = without(collapse(F.regexp_replace(strip_tags(text), REDIRECT, "")), title)
    other = F.coalesce(F.nullif(F.coalesce(description, F.lit("")), F.lit("")), F.coalesce(title, F.lit("")))
    return _let(body, lambda x: trim(F.substring(F.when(x != "", x).otherwise(other), 1, most)))


def content_lines(text: Column) -> Column:
    """Tidied lines that aren't empty or navigation noise."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\n+"), tidy), lambda x: (x != "") & ~F.rlike(x, F.lit(NOISE)))


def search_snippet(title: Column, description: Column, summary_: Column, text: Column, most: int = 320) -> Column:
    """Description or summary and the content lines, headed by the title unless they start with it."""
    lead = F.coalesce(F.nullif(F.coalesce(description, F.lit("")), F.lit("")), F.coalesce(summary_, F.lit("")))
    parts = F.filter(F.concat(F.array(lead), content_lines(text)), lambda x: x != "")
    body = collapse(F.array_join(parts, " "))
    name = F.coalesce(title, F.lit(""))
    headed = lambda x: F.when((name != "") & ~F.startswith(F.lower(x), F.lower(name)), F.concat(name, F.lit(" — "), x)).otherwise(x)
    return _let(body, lambda x: F.substring(headed(x), 1, most))


def letters(c: Column, kind: str) -> Column:
    """How many Arabic (``ar``) or Latin (``latin``) letters a text holds."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"[\x{0600}-\x{06FF}]" if kind == "ar" else "[A-Za-z]"))


def quality(title: Column, description: Column, text: Column, content_type: Column) -> Column:
    """(status, language): not_indexable_api, blocked_challenge, dynamic_content, thin_content or good; ar, latin or unknown."""
    t, d, x = (F.coalesce(c, F.lit("")) for c in (title, description, text))
    both = F.concat_ws(" ", t, d, x)
    api = ~F.coalesce(content_type, F.lit("")).rlike("(?i)html") | ((t == "") & (d == "") & (F.length(x) < 1000))
    status = (
        F.when(api, "not_indexable_api").when(both.rlike(CHALLENGE), "blocked_challenge").when((t != "") & (F.length(x) < 20), "dynamic_content")
        .when((F.length(x) < 300) & (d == ""), "thin_content").otherwise("good")
    )
    ar, latin = letters(both, "ar"), letters(both, "latin")
    return F.struct(status.alias("status"), F.when(ar > latin, "ar").when(latin > 0, "latin").otherwise("unknown").alias("language"))
