"""Benchmark decontamination by templates: DataFrame functions only.

Numbers, units and names of benchmark items and documents become typed
placeholders: one for a whole number, one for a run of name words. Windows of
words, and of template words, are hashed and joined. Where a window matches, the
item is laid beside the document on the diagonals (place in the document minus
place in the item) of its windows, neighbouring ones together, and compared word
for word. It is found where enough words match and its slots are filled
consistently: each filler of the item maps to one filler of the document
throughout, and two names of the item to two of the document. So a verbatim copy, a question with other numbers or names and a copy
with a word changed, dropped or put in are all caught.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitscope.llm.common import id_and_text, save

# Words that name a unit when they follow a number.
UNITS = [
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "ton", "tons", "ounce", "ounces", "pound", "pounds",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "cent", "cents", "dollar", "dollars", "euro", "euros", "percent",
]
# Placeholders begin with a character that no cleaned text holds; JOINED ties the names of a run.
SLOT, NAMED, JOINED = "\x01", "\x02", "\x03"
NUMBER, UNIT, NAME = SLOT + "n", SLOT + "u", SLOT + "a"
#: Windows of items, or documents with a hit, that a job may broadcast; more of them are joined by a shuffle.
_BROADCAST = 2_000_000
#: In shorter runs of matching words fillers must be the same, as placeholders also match by chance.
_RUN = 3
#: Diagonals to either side of one with a window that are compared too: words dropped or put in near a border.
_SHIFT = 3
WORDS, TEMPLATE = 0, 1
_CAPITAL = r"\p{Lu}\p{Ll}+"


def _marked(text: Column) -> Column:
    """A mark before each name: a capitalised word that follows a word or a comma."""
    plain = F.translate(text, SLOT + NAMED + JOINED, "   ")
    return F.regexp_replace(plain, rf"(?<=[\p{{L}}\p{{N}},;][ \n\t])({_CAPITAL})(?![\p{{L}}\p{{N}}])", NAMED + "$1")


def _with_openers(frame: DataFrame) -> DataFrame:
    """Capitalised words that open the text or follow a stop may just begin a sentence: names if they are one elsewhere."""
    capital = F.regexp_extract_all("marked", F.lit(rf"(?<![\p{{L}}\p{{N}}\x02])(\x02?{_CAPITAL})(?![\p{{L}}\p{{N}}])"))
    frame = frame.withColumn("capital", F.array_distinct(capital))
    names = F.transform(F.filter("capital", lambda w: F.startswith(w, F.lit(NAMED))), lambda w: F.ltrim(w, F.lit(NAMED)))
    frame = frame.withColumn("opening", F.array_intersect("capital", names))
    pattern = F.concat(
        F.lit(r"(?<![\p{L}\p{N}\x02])(?=\p{Lu})("), F.array_join("opening", "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    more = F.when(F.size("opening") > 0, F.regexp_replace("marked", pattern, F.lit(NAMED + "$1")))
    return frame.withColumn("marked", F.coalesce(more, "marked")).drop("capital", "opening")


def _cleaned(marked: Column) -> Column:
    """Words and whole numbers, one space apart; runs of names are tied together."""
    tied = F.regexp_replace(marked, r"(\x02\p{L}+)[ \n\t]+(?=\x02)", "$1" + JOINED)
    # Stops first, then the rest: repeating a choice of patterns would take a stack frame for each character.
    stops = F.regexp_replace(tied, r"(?<!\p{N})[.,]|[.,](?!\p{N})", " ")
    return F.trim(F.regexp_replace(stops, r"[^\p{L}\p{N}\x02\x03.,]+", " "))


def _template(clean: Column) -> Column:
    """A cleaned text in lower case, with a placeholder for each run of names, number and unit."""
    typed = F.lower(F.regexp_replace(clean, NAMED + "[^ ]+", NAME))
    typed = F.regexp_replace(typed, r"(?<![^ ])\p{N}[\p{N}.,]*(?![^ ])", NUMBER)
    return F.regexp_replace(typed, NUMBER + " (?:" + "|".join(UNITS) + ")(?![^ ])", NUMBER + " " + UNIT)


def _read(frame: DataFrame, *keys: str) -> DataFrame:
    """*keys*, ``clean`` of the texts that hold a word."""
    # A filter on the cleaned text would be pushed down and work it out several times over.
    worded = frame.filter(F.col("text").rlike(r"[\p{L}\p{N}]"))
    marked = _with_openers(worded.select(*keys, _marked(F.col("text")).alias("marked")))
    return marked.select(*keys, _cleaned(F.col("marked")).alias("clean"))


def _apart(clean: Column) -> Column:
    return F.translate(clean, JOINED, " ")


def _plain(clean: Column) -> Column:
    """Lower-case words without marks."""
    return F.split(F.lower(F.translate(clean, JOINED + NAMED, " ")), " ")


def _doubled(hashes: str, step: int) -> Column:
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def _with_halves(frame: DataFrame, words: str, longest: int) -> DataFrame:
    """*frame* with ``{words}_2``, ``{words}_4``, ...: hashes of so many words from each place on, fewer than *longest*.

    Each is made of two of the one before, so a window of any length costs two
    look-ups in place of one for each word. The last places of each, short of words, are of no use.
    """
    whole, step = words, 1
    while 2 * step < longest:
        frame = frame.withColumn(f"{words}_{2 * step}", _doubled(whole, step))
        whole, step = f"{words}_{2 * step}", 2 * step
    return frame


def _half(length: int) -> int:
    """Words of the two halves, which may overlap, of a window."""
    return 1 << max(0, (length - 1).bit_length() - 1)


def _hash(path: Column, words: str, length: int, h: Column, at: Column) -> Column:
    """Hash of the window at a place, counted from 0, whose first half has hash *h*."""
    half = _half(length)
    return F.xxhash64(path, h, F.get(words if half == 1 else f"{words}_{half}", at + (length - half)))


def _item_windows(items: DataFrame, width: int) -> DataFrame:
    """``item_id, path, length, at, h``: the windows of items by which they are looked up.

    A word changed in the middle of a short item must leave a window whole, so
    items of up to twice *width* words have windows of just under half their
    words. Those of fewer than *width* + 2 words have to match as a whole.
    Template windows hold at most a third of slots; an item that has none such
    gets longer ones, with at most half of slots. Words are looked up as they are in any case.
    """
    n = F.size("words")
    length = (
        F.when(n < width + 2, F.least(n, F.lit(width))).when(n <= 2 * width, F.floor((n - 1) / 2)).otherwise(width)
    ).cast("int")
    plain = items.select("item_id", F.lit(WORDS).alias("path"), _plain(F.col("clean")).alias("words"))
    typed = items.filter(F.col("clean").rlike(r"\x02|\p{N}")).select(
        "item_id", F.lit(TEMPLATE).alias("path"), F.split(_template(F.col("clean")), " ").alias("words")
    )

    def cut(frame: DataFrame, length: Column) -> DataFrame:
        parts = frame.withColumn("length", length).withColumn(
            "at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
        )
        return parts.withColumn("part", F.slice("words", F.col("at"), F.col("length"))).withColumn(
            "slots", F.size(F.filter("part", lambda w: F.startswith(w, F.lit(SLOT))))
        )

    sparse = cut(typed, length).filter(F.col("slots") * 3 <= F.col("length"))
    dense = typed.join(sparse.select("item_id").distinct(), "item_id", "leftanti")
    longer = cut(dense, F.least(n, F.lit(2 * width))).filter(F.col("slots") * 2 <= F.col("length"))
    parts = cut(plain, length).unionByName(sparse).unionByName(longer)
    parts = _with_halves(parts.withColumn("part", F.transform("part", lambda w: F.xxhash64(w))), "part", 2 * width)
    hashed = F.lit(None)
    for n in range(1, 2 * width + 1):
        first = F.get("part" if _half(n) == 1 else f"part_{_half(n)}", F.lit(0))
        hashed = F.when(F.col("length") == n, _hash(F.col("path"), "part", n, first, F.lit(0))).otherwise(hashed)
    return parts.select("item_id", "path", "length", "at", hashed.alias("h"))


def _doc_windows(texts: DataFrame, keys: list[str], lengths: dict[int, list[int]]) -> DataFrame:
    """*keys*, ``n0, n1, place, h``: hashes of the documents' windows of the given lengths, one path and length after the other."""
    numbers = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    slotted = F.col("clean").rlike(r"\x02|\p{N}") if TEMPLATE in lengths else F.lit(False)
    read = texts.select(
        *keys,
        numbers(_plain(F.col("clean"))).alias("words0"),
        F.when(slotted, numbers(F.split(_template(F.col("clean")), " "))).alias("words1"),
    )
    for path, own in lengths.items():
        read = _with_halves(read, f"words{path}", max(own))
    none = F.array().cast("array<bigint>")

    def windows(path: int, length: int) -> Column:
        words = f"words{path}"
        first = words if _half(length) == 1 else f"{words}_{_half(length)}"
        whole = F.slice(first, F.lit(1), F.greatest(F.array_size(words) - (length - 1), F.lit(0)))
        cut = F.transform(whole, lambda h, at: _hash(F.lit(path), words, length, h, at))
        return F.coalesce(cut, none)

    size = lambda path: F.coalesce(F.array_size(f"words{path}"), F.lit(0)).alias(f"n{path}")
    parts = [windows(path, length) for path, own in lengths.items() for length in own]
    return read.select(*keys, size(WORDS), size(TEMPLATE), F.posexplode(F.concat(*parts)).alias("place", "h"))


def _place(lengths: dict[int, list[int]]) -> tuple[Column, Column]:
    """Path of a window of ``_doc_windows``, and its first word, counting from 1; worked out for hits only."""
    path, position, before = F.lit(None), F.lit(None), F.lit(0)
    steps = []
    for number, own in lengths.items():
        for length in own:
            steps.append((number, before))
            before = before + F.greatest(F.col(f"n{number}") - length + 1, F.lit(0))
    for number, start in steps:
        here = F.col("place") >= start
        path, position = F.when(here, number).otherwise(path), F.when(here, F.col("place") - start + 1).otherwise(position)
    return path.cast("int"), position.cast("int")


def _words(frame: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """*keys*, ``path`` and arrays of the words as written and as placeholders, word for word and with runs tied."""
    one = F.lit(WORDS).alias("path"), _apart(F.col("clean")).alias("form")
    two = F.lit(TEMPLATE).alias("path"), F.col("clean").alias("form")
    both = frame.select(*keys, *one).unionByName(frame.select(*keys, *two))
    return both.select(
        *keys,
        "path",
        F.split(F.lower(F.translate("form", NAMED, "")), " ").alias(prefix + "_words"),
        F.split(_template(F.col("form")), " ").alias(prefix + "_typed"),
    )


def contaminations(docs: DataFrame, benchmark: DataFrame, width: int = 8, coverage: float = 0.6) -> DataFrame:
    """``doc_id, item_id, start, n_windows, n_matched, coverage, kind``: where documents hold items.

    *start* is the word (from 1) of the document at which the item would begin, *kind*
    "verbatim" or "template" (some filler differs). *n_windows* is the number of
    windows of *width* words of an item, *n_matched* the number of its words that
    match, less *width* - 1: the windows that an unbroken match of so many words
    holds. At least *coverage* of them must match with consistent slots; in
    a template half of the matching words must be the same, or two thirds of the windows must match and with them
    at least *width* slots and three different words that are the same (an item dense in slots). An item with fewer words than *width* is one window of its own length and
    is found wherever a document holds these words, even a single one. NULL or empty
    texts and rows without an id hold nothing and are held by nothing; repeated rows
    give one row.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).filter(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    # The same id may come with several texts.
    items = _read(items.distinct(), "item_id", "text").withColumn("item", F.struct("item_id", F.xxhash64("text").alias("of")))
    items = items.select(F.col("item").alias("item_id"), "clean")
    own = save(_item_windows(items, width), "item-windows")
    lengths: dict[int, list[int]] = {}
    for row in own.select("path", "length").distinct().orderBy("path", "length").collect():
        lengths.setdefault(row["path"], []).append(row["length"])
    small = own.limit(_BROADCAST + 1).count() <= _BROADCAST

    keys = ["doc_id", "of"]
    read = id_and_text(docs).filter("doc_id IS NOT NULL").withColumn("of", F.xxhash64("text"))
    cut = _doc_windows(_read(read, *keys), keys, lengths or {WORDS: [width]})
    sought = own.select("item_id", "at", "h")
    # A diagonal of a document and an item: the word of the document at which the item would begin.
    path, position = _place(lengths or {WORDS: [width]})
    hits = cut.join(F.broadcast(sought) if small else sought, "h").select(
        *keys, "item_id", path.alias("path"), (position - F.col("at") + 1).alias("diagonal")
    )
    hits = save(hits.distinct(), "item-hits")

    pair = [*keys, "item_id", "path"]
    along = Window.partitionBy(*pair).orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > width).cast("int")
    grouped = hits.withColumn("place", F.sum(F.coalesce(apart, F.lit(0))).over(along))
    shifted = F.explode(F.sequence(F.col("diagonal") - _SHIFT, F.col("diagonal") + _SHIFT)).alias("beside")
    grouped = (
        grouped.select(*pair, "place", "diagonal", shifted)
        .groupBy(*pair, "place", F.col("beside").alias("diagonal"))
        .agg(F.max(F.abs(F.col("beside") - F.col("diagonal")) <= 1).alias("sure"))
    )
    # Texts are read again only where there is a hit.
    hit = hits.select(*keys).distinct()
    few = hit.limit(_BROADCAST + 1).count() <= _BROADCAST
    again = read.join(F.broadcast(hit) if few else hit, keys, "leftsemi").dropDuplicates(keys)
    texts = _words(_read(again, *keys), keys, "doc")
    forms = _words(items, ["item_id"], "item")
    beside = grouped.join(F.broadcast(forms) if small else forms, ["item_id", "path"]).join(texts, [*keys, "path"])

    place = [*pair, "place"]
    spot = F.col("at") + F.col("diagonal") - 1
    laid = beside.withColumn("n", F.size("item_words")).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n"))))
    word = lambda column, i: F.get(column, i - 1)
    laid = laid.select(
        *place, "diagonal", "sure", "n", "at",
        word("item_words", F.col("at")).alias("own"),
        word("doc_words", spot).alias("other"),
        word("item_typed", F.col("at")).alias("own_type"),
        word("doc_typed", spot).alias("other_type"),
    ).withColumn("good", F.coalesce((F.col("own") == F.col("other")) | (F.col("own_type") == F.col("other_type")), F.lit(False)))
    line = Window.partitionBy(*place, "diagonal").orderBy("at")
    broken = laid.withColumn("part", F.sum((~F.col("good")).cast("int")).over(line)).filter("good")
    runs = broken.withColumn("run", F.count("*").over(Window.partitionBy(*place, "diagonal", "part")))
    # Each word of an item counts once, on the diagonal where its run is longest.
    long = F.col("run") >= F.least(F.lit(_RUN), F.col("n"))
    best = runs.filter(long | (F.col("sure") & (F.col("own") == F.col("other")))).groupBy(*place, "n", "at").agg(
        F.max_by(F.struct("own", "other", "own_type", "diagonal", "run"), F.struct("run", "sure", -F.col("diagonal"))).alias("b")
    )
    # One row for each filler of the item.
    fillers = (
        best.groupBy(*place, "n", "b.own", F.startswith("b.own_type", F.lit(SLOT)).alias("slot"))
        .agg(
            F.count("*").alias("words"),
            F.sum((F.col("b.own") == F.col("b.other")).cast("int")).alias("same"),
            F.min("b.other").alias("low"),
            F.max("b.other").alias("high"),
            F.first("b.own_type").alias("type"),
            F.max(F.struct("b.run", (-F.col("b.diagonal")).alias("back"))).alias("longest"),
        )
    )
    named = F.col("type") == NAME
    judged = fillers.groupBy(*place, "n").agg(
        F.sum("words").alias("words"),
        F.sum("same").alias("same"),
        (
            F.bool_and(~F.col("slot") | (F.col("low") == F.col("high")))
            # Not more names than an item has words, so the sets are small.
            & (F.size(F.collect_set(F.when(named, F.col("low")))) == F.count_if(named))
        ).alias("consistent"),
        F.sum(F.when(F.col("slot"), F.col("words")).otherwise(0)).alias("slots"),
        F.count_if(~F.col("slot") & (F.col("same") > 0)).alias("plain"),
        F.max("longest").alias("longest"),
    )
    span = F.least(F.col("n"), F.lit(width))
    judged = judged.withColumn("n_windows", (F.col("n") - span + 1).cast("long")).withColumn(
        "n_matched", F.greatest(F.col("words") - span + 1, F.lit(0))
    )
    share = F.col("n_matched") / F.col("n_windows")
    dense = (share >= F.greatest(F.lit(2 / 3), F.lit(coverage))) & (F.col("slots") >= width) & (F.col("plain") >= 3)
    alike = (F.col("same") * 2 >= F.col("words")) | dense
    judged = judged.filter((share >= coverage) & F.col("consistent") & alike).withColumn(
        "diagonal", -F.col("longest.back")
    )
    # Places in tied words become places in words.
    tied = F.slice(F.split("clean", " "), 1, F.greatest(F.col("diagonal") - 1, F.lit(0)))
    more = F.aggregate(tied, F.lit(0), lambda n, w: n + F.length(w) - F.length(F.translate(w, JOINED, "")))
    cleans = _read(again, *keys)
    judged = judged.join(cleans, keys).withColumn("start", F.col("diagonal") + F.when(F.col("path") == TEMPLATE, more).otherwise(0))
    # The same place found both ways, or at places a few words apart, is one.
    near = Window.partitionBy(*keys, "item_id").orderBy("start", "path")
    new = F.coalesce((F.col("start") - F.lag("start").over(near) > width).cast("int"), F.lit(0))
    first = Window.partitionBy(*keys, "item_id", "spot").orderBy(F.desc(share), "path", "start")
    one = judged.withColumn("spot", F.sum(new).over(near)).withColumn("place", F.row_number().over(first)).filter("place = 1")
    return one.select(
        "doc_id",
        "item_id.item_id",
        "start",
        "n_windows",
        "n_matched",
        share.alias("coverage"),
        F.when(F.col("same") == F.col("words"), "verbatim").otherwise("template").alias("kind"),
    ).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """*docs* without the documents that hold an item; rows without an id hold none and stay."""
    bad = contaminations(docs, benchmark).select("doc_id").distinct().alias("contaminated")
    rows = docs.alias("documents")
    return rows.join(bad, F.col("documents.doc_id") == F.col("contaminated.doc_id"), "leftanti")
