"""Problem 5: template residue, filler text, error pages and notices about scripts.

Records of one template are *aligned*: what varies from record to record (paths, hosts, numbers, codes, and the placeholder
itself) is masked, and values with the same remaining words form a template.  Its masked positions are the slots.

* A snippet whose whole template recurs on ``TEMPLATE_SITES`` sites, under as many different titles, is not an author's text but the
  page of a program: an error page, a default, a variable name that was never filled.  No list of words is needed for it.
* A title that heads such snippets, or others that are residue as a whole, on many sites is that program's title.

What these leave (residue inside an author's sentence, rare messages) is found by fixed patterns:

* A slot that retains a variable name, a default or a blank is residue.  A placeholder among words whose sentence speaks
  of variables, templates or how they are written is no slot but part of a text about placeholders, and is not marked:
  with two such words at once, with one if the same words surround it in several different texts.  However often it is
  repeated, a placeholder without such words is marked.
* A whole-page template (error, maintenance, default page, script notice, browser check) is one whose words come from the
  server, with the request's path or the host in its slot: a line that repeats the record's own path or host, in a
  template that several records share or whose words are known messages.  Without a path or host, a short snippet that is
  nothing but a known title, or a known message that several sites share word for word, is one too.
* A title is compared as a whole, without the site's name, with the known messages.

Edge cases: rows without a key are left out; null and empty values are never marked (a blank that a template printed cannot be told from a missing one);
repeated rows count once per distinct site in the template counts; texts are processed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raqim.llm.hosts import site
from raqim.llm.lookalike import SUSPECT, Forms, form_table, normalizer
from raqim.session import checkpointed

#: How template languages write a variable, a block or a merge field.
PLACEHOLDER = re.compile(
    r"\{\{\{?[^{}\n]+\}?\}\}|\{%-?[^%\n]+%\}|<%[=#-]?[^%\n]+%>|<\?(?:=|php)[^?\n]+\?>|#\{[^{}\n]+\}|\$\{[^{}\n]+\}"
    r"|\[\[[+*~$!%]?[^\[\]\n]+\]\]|\*\|[^|\n]+\|\*|@@[\w.\- ]+@@|__[^\W_][\w.\-]*__|%%?(?![0-9A-Fa-f]{2}%)[^\W\d][\w.\-]+%%?(?![0-9A-Fa-f]{2})"
    r"|@(?:Model|ViewBag|ViewData)\.[\w.]+|&lt;[^\W\d][\w.\- ]*&gt;|(?<![{$#])\{[^\W\d][\w.\-]+\}(?!\})|\[[A-Z][A-Z_]{3,}\]"
)
#: What a program prints for an empty value.
EMPTY = {"null", "nil", "none", "nan", "undefined", "n/a", "(none)", "(null)", "[object object]", "array", "object", "[object undefined]", "<null>", "#n/a", "#ref!", "inf", "-nan", "nonetype"}
_EMPTY_STARTS = tuple(x.split()[0] for x in sorted(EMPTY)) + tuple("-|–—:/,;")
#: Known titles without the site's name, digits masked as 0.
TITLES = re.compile(
    r"(?:error|erreur|fehler|خطأ|خطا|http|http error|status)[ :#]*0|0 ?[:\-–]? ?(?:not found|forbidden|unauthorized|bad request|service unavailable|gateway time-?out|bad gateway|internal server error|error|too many requests)|"
    r"(?:page |file |document )?not found|page introuvable|الصفحة غير متاحة|الصفحة غير موجودة|تعذر الوصول|الوصول مرفوض|غير مصرح|(?:internal )?server error|erreur interne(?: du serveur)?|خطأ داخلي(?: في الخادم)?|"
    r"access denied|acces refuse|accès refusé|forbidden|default (?:web )?page|page par défaut|الصفحة الافتراضية|untitled(?: page| document)?|sans titre|غير معنون|بلا عنوان|بدون عنوان|(?:site |website |page )?under construction|"
    r"site en construction|(?:قريبا: )?الموقع قيد (?:الإنشاء|الانشاء|الصيانة)|coming soon|maintenance(?: mode)?|en maintenance|javascript (?:is )?(?:required|disabled|requis|désactivé)|enable javascript|activez javascript|"
    r"مطلوب تفعيل جافا ?سكربت|just a moment\.*|attention required!?|please wait\.*|un instant\.*|لحظة من فضلك|welcome to (?:nginx|apache)!?|apache\w* .*default page|index of /.*|account suspended|service unavailable|service indisponible|الخدمة غير متاحة|bad request|gateway time-?out|"
    r"página no encontrada|página não encontrada|seite nicht gefunden|страница не найдена|صفحه یافت نشد|siden blev ikke fundet|loading\.*"
)
#: Words of messages that a server or a script prints, as searched in a line.
MESSAGES = re.compile(
    r"enable javascript|activer javascript|enable (?:scripts|cookies)|turn scripts on|scripting disabled|noscript|scripts? (?:is|are) (?:required|disabled)|exige les scripts|scripts du navigateur|without javascript|checking your browser|"
    r"vérification de votre navigateur|confirm you are human|are (?:you )?(?:a )?human|not a robot|could not locate|was not found on this server|access denied|no permission|accès refusé|est introuvable|n.existe plus|service unavailable|service indisponible|bad request|invalid host|"
    r"internal fault|internal error|gateway timeout|gateway time-?out|has been suspended|under maintenance|fatal error|uncaught|traceback|warning: \w+\(|parse error|stack trace|trace code|exception in|mysqli?_|sqlstate|on line 0|"
    r"يرجى تفعيل جافا|تفعيل جافا ?سكربت لعرض|لا يدعم البرامج النصية|يحتاج إلى تشغيل javascript|نتحقق من متصفحك|لست برنامجا آليا|ليس لديك صلاحية|الخادم مشغول|خلل داخلي|لم نعثر على|متوقف مؤقتا للصيانة|تعذر الاتصال|"
    r"انتهت مهلة|غير موجودة على هذا الخادم|رمز التتبع|قيد الصيانة|تم إيقاف|включите javascript|ativar javascript|ative o javascript|aktivieren sie javascript|habilite javascript|aktiver javascript|جاوا ?اسکریپت را فعال"
)
#: Messages that need no path or host of the request to be the page's whole text.
WHOLE = re.compile(
    r"traceback \(most recent call last\)|fatal error: uncaught|warning: \w+\(\): \(|parse error: syntax error|loading\.\.\. noscript|this account on \S+ has been suspended|bad request - invalid host|0 service unavailable|gateway timeout while"
)
#: Words of Lorem ipsum.
LOREM = set(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
#: Sentences that stand in for text to come.
FILLER = re.compile(
    r"هذا نص تجريبي|نص تجريبي سيستبدل|أدخل المحتوى|ادخل المحتوى|اكتب وصف|نص مؤقت|فقرة مثال|هذا النص هو مثال|هذا النص مثال|لوريم إيبسوم|مثال لنص|"
    r"saisissez votre|texte provisoire|paragraphe provisoire|faux texte|texte d.exemple|insérez votre|votre texte ici|contenu à venir|"
    r"placeholder copy|replace (?:this|before launch)|sample text|insert your|placeholder text|demo paragraph|dummy text|your text here|text goes here|enter your (?:text|description|content)|type your (?:text|description)|this is (?:a )?(?:sample|placeholder|demo)|add your (?:text|description)|"
    r"texto de (?:exemplo|ejemplo|relleno)|beispieltext|platzhaltertext|текст[- ]заполнитель|متن نمونه|eksempeltekst"
)
#: A value without one of these cannot match FILLER; a line without one of the next cannot hold a path or a host.
FILLER_HINTS = ("نص ", "أدخل", "ادخل", "اكتب وصف", "فقرة مثال", "لوريم", "saisissez", "provisoire", "faux texte", "texte d", "insérez", "votre texte", "contenu à", "copy", "replace", "sample", "your", "placeholder", "dummy", "text goes", "this is", "demo par", "texto de", "beispiel", "platzhalter", "текст", "متن نمونه", "eksempel")
MARKS = re.compile(r"[{<\[*@_%$&#]")
PATH = re.compile(r"(?<![\w/])(?:/[\w\-.%~]+)+/?")
HOST = re.compile(r"(?<![\w@/.\-])(?:https?://)?(?:[a-z0-9\-]+\.)+[a-z]{2,}(?:/[^\s,;]*)?")
CODE = re.compile(r"(?<![\w])(?=[0-9a-f]*\d)[0-9a-f]{4,}(?![\w])|\d+")
NAME = re.compile(r"[a-z0-9]\.[a-z]|\.\.\. noscript|\(most recent|Uncaught|\(\): ")
BREAK = re.compile(r"\r\n|\n|\r")
SUFFIX = re.compile(r" (?:\||-|–|—|::|·|») [^|]*$")
WORDS = re.compile(r"[^\W_]+")
#: A template without a word or placeholder is a list of links or numbers.
SPOKEN = re.compile(r"[^\W\d_]{2}|\x02")
#: Words of texts about placeholders, as they are searched in the sentence around one.
ABOUT = re.compile(
    r"\b(?:placeholders?|templates?|templating|variables?|syntax|written as|write it as|merge (?:tags?|fields?)|double braces|curly braces|markup|modèles?|gabarits?|syntaxe|s'écrit|balises?|accolades|espaces? réservés?|"
    r"vorlagen?|platzhalter|variablen?|plantillas?|marcador(?:es)?|modelos?|variáveis|variável|шаблон\w*|переменн\w*|skabelon\w*|variabel\w*)\b|القوالب|قوالب|القالب|المتغيرات|متغيرات|المتغير|العناصر النائبة|الصيغة البرمجية|متغیر|قالب‌",
    re.IGNORECASE,
)
SENTENCES = re.compile(r"(?<=[.!?؟])\s+|[\r\n]+")
#: A whole-snippet message without a path is at most so long.
MESSAGE_LENGTH = 160
MIN_SHARED = 3
ABOUT_MIN = 3
#: A whole snippet's template is a program's if so many sites have it, under so many titles.
TEMPLATE_SITES = 5
#: A title heads residue if so large a part of its records, on so many sites, is residue as a whole.
TITLE_SITES, TITLE_SHARE = 5, 0.4
#: A path or host shorter than this is found in too many texts to tell whose it is.
OWN_LEAST = 5


def mask(line: str) -> str:
    """The line as its template: slots for placeholders, hosts, paths, codes and numbers."""
    line = PLACEHOLDER.sub("\x02", line)
    line = HOST.sub("\x03", line)
    line = PATH.sub("\x04", line)
    return " ".join(CODE.sub("0", line).split())


def title_core(title: str) -> str:
    """The title without the site's name, which follows a separator, and with numbers as 0."""
    t = SUFFIX.sub("", " ".join(title.split()))
    return re.sub(r"\d+", "0", t.lower()).strip(" .!")


def is_empty_value(text: str) -> bool:
    """Nothing but what a program prints for an empty value, once or several times."""
    t = text.strip().lower()
    if t in EMPTY:
        return True
    if not t.startswith(_EMPTY_STARTS):
        return False
    parts = [p for p in re.split(r"\s+[-|–—:/]\s+|[,;|\n]+|:\s+", t) if p.strip()]
    words = [w for p in parts for w in (p.split() if p.strip() not in EMPTY else [p.strip()])]
    return bool(words) and all(w in EMPTY for w in words)


def trailing_empty(line: str) -> bool:
    """An empty value printed after the text of a line."""
    m = re.search(r"(?:^|[.!?؟:|،,]|\s-)\s*(undefined|null|nan|nil|\[object object\]|\(none\)|n/a)\s*$", line, re.IGNORECASE)
    return bool(m)


def is_filler(text: str) -> bool:
    low = text.lower()
    if any(h in low for h in FILLER_HINTS) and FILLER.search(low):
        return True
    if not text.isascii():
        return False
    words = re.findall(r"[a-z]+", low)
    return len(words) >= 4 and sum(w in LOREM for w in words) >= 0.8 * len(words) and len(set(words) & LOREM) >= 3


def _contexts(line: str) -> list[str]:
    """Each placeholder with up to two words on either side: '' where the line holds nothing else."""
    out, pieces, last = [], [], 0
    if not MARKS.search(line):
        return out
    for m in PLACEHOLDER.finditer(line):
        pieces.append((line[last : m.start()], m.group()))
        last = m.end()
    tail = line[last:]
    for i, (before, hit) in enumerate(pieces):
        after = pieces[i + 1][0] if i + 1 < len(pieces) else tail
        left, right = WORDS.findall(before)[-2:], WORDS.findall(after)[:2]
        out.append(f"{' '.join(left)}\x02{hit}\x02{' '.join(right)}" if left and right else "")
    return out


def _spoken_of(line: str) -> list[int]:
    """For each placeholder, in order: how many different words of its sentence, two at most, speak of placeholders."""
    hits = [m.start() for m in PLACEHOLDER.finditer(line)]
    bare = PLACEHOLDER.sub(lambda m: "\x02" * len(m.group()), line)
    ends = [m.start() for m in SENTENCES.finditer(bare)]
    out = []
    for at in hits:
        start, end = max((e for e in ends if e < at), default=0), min((e for e in ends if e > at), default=len(bare))
        out.append(min(2, len({m.group().lower() for m in ABOUT.finditer(bare[start:end])})))
    return out


def _placeholders(out: list, k: int, s: str, field: str, line: str, text: str) -> None:
    found = _contexts(line)
    if found:
        shape = xxhash.xxh64_intdigest(mask(text)) - (1 << 63)
        for c, n in zip(found, _spoken_of(line), strict=True):
            if not c or n < 2:
                out.append((k, s, field, "placeholder", c, not c or not n, shape))


def _candidates(rules: Forms):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        norm = normalizer(rules)
        for pdf in batches:
            out: list[tuple] = []
            for k, s, path, title, snippet in zip(pdf["id"], pdf["site__"], pdf["path__"], pdf["title"], pdf["snippet"], strict=True):
                head = ""
                if isinstance(title, str) and title.strip():
                    text = norm.scan(title, "ar")[1] if SUSPECT.search(title) else title
                    head = _title(out, k, s, text)
                if isinstance(snippet, str) and snippet.strip():
                    text = norm.scan(snippet, "ar")[1] if SUSPECT.search(snippet) else snippet
                    _snippet(out, k, s, path, text)
                    whole = mask(text).lower()
                    if SPOKEN.search(whole):
                        out.append((k, s, "snippet", "whole", head, False, xxhash.xxh64_intdigest(whole) - (1 << 63)))
            yield pd.DataFrame(
                {
                    "id": pd.Series([r[0] for r in out], dtype="int64"), "site": pd.Series([r[1] for r in out], dtype=object), "field": pd.Series([r[2] for r in out], dtype=object),
                    "rule": pd.Series([r[3] for r in out], dtype=object), "template": pd.Series([r[4] for r in out], dtype=object), "sure": pd.Series([r[5] for r in out], dtype=bool),
                    "shape": pd.Series([r[6] for r in out], dtype="int64"),
                }
            )

    return run


def _snippet(out: list, k: int, s: str, path: str, text: str) -> None:
    pieces = BREAK.split(text)
    if is_empty_value(text):
        out.append((k, s, "snippet", "empty", "", True, 0))
    elif any(trailing_empty(x) for x in pieces if x[-1:] in "dlnNLaAtT])D" and x):
        out.append((k, s, "snippet", "default", "", True, 0))
    if is_filler(text):
        out.append((k, s, "snippet", "filler", "", True, 0))
    if len(text) <= MESSAGE_LENGTH:
        whole = mask(text.lower())
        if TITLES.fullmatch(title_core(text)):
            out.append((k, s, "snippet", "page", whole, True, 0))
        elif MESSAGES.search(re.sub(r"\d+", "0", text.lower())):
            out.append((k, s, "snippet", "page", whole, False, 0))
    for line in pieces:
        _placeholders(out, k, s, "snippet", line, text)
        if "/" not in line and not NAME.search(line):
            continue
        low = line.lower()
        own = (len(path) >= OWN_LEAST and path in low) or (len(s) >= OWN_LEAST and s in low)
        message = MESSAGES.search(re.sub(r"\d+", "0", low))
        if own or message:
            # the sentence that holds the path or the host, with its words; what precedes it may be an author's text
            for part in re.split(r"(?<=[.!?؟])\s+(?=\S{2,} \S)", low):
                has = (len(path) >= OWN_LEAST and path in part) or (len(s) >= OWN_LEAST and s in part) or PATH.search(HOST.sub("", part)) is not None
                shape = mask(part)
                said = MESSAGES.search(shape.replace("\x04", "/p").replace("\x03", "h")) or (message and MESSAGES.search(low))
                if has and said:
                    out.append((k, s, "snippet", "page", shape, True, 0))
                elif has and own:
                    out.append((k, s, "snippet", "page", shape, False, 0))
            if WHOLE.search(re.sub(r"\d+", "0", low)):
                out.append((k, s, "snippet", "page", mask(low), True, 0))


def _title(out: list, k: int, s: str, text: str) -> str:
    """The title's template, after its marks."""
    core = title_core(text)
    bare = SUFFIX.sub("", " ".join(text.split()))
    if is_empty_value(text) or is_empty_value(bare):
        out.append((k, s, "title", "empty", core, True, 0))
    if is_filler(text):
        out.append((k, s, "title", "filler", core, True, 0))
    _placeholders(out, k, s, "title", text, text)
    if TITLES.fullmatch(core):
        out.append((k, s, "title", "page", core, True, 0))
    head = mask(bare).lower().strip(" .!")
    out.append((k, s, "title", "head", head, False, 0))
    return head


def residue(df: DataFrame, key: str = "id") -> DataFrame:
    """(id, field, rule) of each value that holds residue; a value may be marked by several rules, of which 'template' is the one
    that knows no words."""
    path = F.lower(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*?)/?(?:index\.html?)?(?:[?#].*)?$", 1))
    source = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(site(F.col("url")), F.lit("")).alias("site__"), F.coalesce(path, F.lit("")).alias("path__"), "title", "snippet")
    rows = source.mapInPandas(_candidates(form_table()), "id long, site string, field string, rule string, template string, sure boolean, shape long")
    found = checkpointed(rows)
    sure = found.filter("sure").select("id", "field", "rule")

    # placeholders among words, of which one speaks of placeholders: different texts decide whether the place is a slot
    placed = found.filter("rule = 'placeholder' and not sure")
    about = placed.groupBy("template").agg(F.countDistinct("shape").alias("texts")).filter(F.col("texts") >= ABOUT_MIN)
    slots = placed.join(about.hint("shuffle_hash"), "template", "left_anti").select("id", "field", "rule")

    # whole-page templates without a known message and messages without a path: shared by several sites
    shapes = found.filter("rule = 'page' and not sure and field = 'snippet'")
    shared = shapes.groupBy("template").agg(F.countDistinct("site").alias("sites")).filter(F.col("sites") >= MIN_SHARED)
    pages = shapes.join(shared, "template", "left_semi").select("id", "field", "rule")

    # whole-snippet templates that many sites have under many titles; counted by hash before sites and titles are told apart
    wholes = found.filter("rule = 'whole'").select("id", "site", F.col("template").alias("head"), "shape")
    often = wholes.groupBy("shape").agg(F.count("*").alias("n")).filter(F.col("n") >= TEMPLATE_SITES).select("shape")
    recurring = wholes.join(often, "shape", "left_semi")
    several = lambda of: recurring.select("shape", of).distinct().groupBy("shape").agg(F.count("*").alias("n")).filter(F.col("n") >= TEMPLATE_SITES).select("shape")
    templates = recurring.join(several("site"), "shape", "left_semi").join(several("head"), "shape", "left_semi").select("id", F.lit("snippet").alias("field"), F.lit("template").alias("rule"))

    # titles that head snippets which are residue as a whole
    marked = sure.filter("field = 'snippet' and rule in ('page', 'empty', 'filler')").union(pages).union(templates).select("id").distinct().withColumn("page", F.lit(1))
    heads = found.filter("rule = 'head'").select("id", "site", "template").join(marked, "id", "left")
    bad = heads.groupBy("template").agg(F.countDistinct("site").alias("sites"), F.avg(F.coalesce("page", F.lit(0))).alias("share")).filter((F.col("sites") >= TITLE_SITES) & (F.col("share") >= TITLE_SHARE))
    titles = heads.join(bad, "template", "left_semi").select("id", F.lit("title").alias("field"), F.lit("template").alias("rule"))
    return sure.union(slots).union(pages).union(templates).union(titles).distinct()
