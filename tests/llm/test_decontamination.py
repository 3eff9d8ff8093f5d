from llm_fixtures import docs_of  # noqa: F401

from tideload.llm import decontamination
from tideload.llm.decontamination import contaminated, decontaminate

ITEM = "Tom has 3 red apples and buys 12 more apples for 5 dollars at the market where Anna sells fruit; how many apples does Tom have now"
WORDS = len(ITEM.split())


def table(spark, *items):
    return spark.createDataFrame(list(items), "item_id long, text string")


def hits(docs, items, **options):
    return sorted(((r.id, r.item, r.covered_words, r.item_words) for r in contaminated(docs, items, **options).collect()), key=str)


def test_reparameterised_and_inconsistent_questions(spark, docs_of):
    changed = ITEM.replace("Tom", "Eva").replace("Anna", "Karl").replace("3", "40").replace("12", "7").replace("dollars", "euros")
    mixed = ITEM.replace("Tom", "Eva", 1)
    wild = ITEM.replace("Tom has", "Eva has").replace("does Tom", "does Ida").replace("Anna", "Eva")
    docs = docs_of(
        (1, f"Some words before. {ITEM}! And after."),
        (2, f"before {changed} after"),
        (3, "Tom has apples and Anna sells fruit at the market, how many are there now"),
        (4, wild), (5, " ".join(ITEM.split()[:14])), (6, " ".join(ITEM.split()[:9])), (7, ITEM.upper()), (8, None), (9, ""),
        (None, ITEM), (10, ITEM), (10, ITEM),
    )
    items = table(spark, (7, ITEM), (5, ITEM), (8, None), (9, ""), (10, "3 4 5 6 7 8 9 10 11 12"), (11, "A short item"))
    n = WORDS
    got = hits(docs, items)
    assert {(i, 5, n, n) for i in (1, 2, 7, 10, None)} <= set(got)
    assert {g[0] for g in got} == {1, 2, 5, 7, 10, None}
    assert {g[1] for g in got} == {5}
    left = sorted(str(r.doc_id) for r in decontaminate(docs, items).collect())
    assert left == ["3", "4", "6", "8", "9"]
    assert hits(docs_of((1, mixed)), items, min_agreement=0.4) == [(1, 5, n, n)]


def test_short_items_and_shuffled_join(spark, docs_of, monkeypatch):
    items = table(spark, (1, "only six plain words are here"), (2, ITEM))
    docs = docs_of((1, "now only six plain words are here, yes"), (2, "six plain words are here"), (3, "x " + ITEM))
    want = [(1, 1, 6, 6), (3, 2, WORDS, WORDS)]
    assert hits(docs, items) == want
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontamination, "BROADCAST_TEXTS", 0)
    assert hits(docs, items) == want


def test_empty_tables_and_clashing_columns(spark, docs_of):
    assert hits(docs_of(), table(spark, (1, ITEM))) == []
    assert hits(docs_of((1, ITEM)), table(spark)) == []
    assert [r.doc_id for r in decontaminate(docs_of((1, ITEM)), table(spark)).collect()] == [1]
    clash = spark.createDataFrame([(1, ITEM, 1, 2), (2, "clean", 3, 4)], "doc_id long, text string, hash int, item int")
    assert decontaminate(clash, table(spark, (1, ITEM))).collect() == clash.where("doc_id = 2").collect()


def test_long_text(spark, docs_of):
    docs = docs_of((1, "filler words " * 60_000 + ITEM), (2, "filler words " * 60_000))
    assert hits(docs, table(spark, (1, ITEM))) == [(1, 1, WORDS, WORDS)]


QUANTITIES = "Tom has 3 apples and Ann has 5 pears. Bob gives Tom 2 plums and Sue gives Ann 4 figs."
NUMBERS = "3 4 5 6 7 8 9 10 11 12 99 100"


def test_letter_case(spark, docs_of):
    docs = docs_of((1, ITEM.upper()), (2, ITEM.lower()), (3, ITEM.title()), (4, f"x {ITEM.upper().replace('12', '77')} y"))
    assert hits(docs, table(spark, (1, ITEM))) == [(i, 1, WORDS, WORDS) for i in (1, 2, 3, 4)]


def test_items_of_numbers_and_names(spark, docs_of):
    """Exact copies, other numbers, other names; items without plain words are found by their exact words."""
    renamed = QUANTITIES.replace("Tom", "Eva").replace("Ann", "Ida").replace("Bob", "Max").replace("Sue", "Kim")
    docs = docs_of(
        (1, QUANTITIES), (2, QUANTITIES.replace("3", "30").replace("5", "50")), (3, f"now {renamed} yes"), (4, f"a {NUMBERS} b"),
        (5, "3 4 5 6 7 8 9 10 11 13 99 100"), (6, "He gives 3 apples and 5 pears to Tom"), (7, "a b c d 1 2 and so on"),
    )
    items = table(spark, (1, QUANTITIES), (2, NUMBERS), (3, "Four words are few"), (4, "1 2 3 4"))
    assert hits(docs, items) == [(1, 1, 20, 20), (2, 1, 20, 20), (3, 1, 20, 20), (4, 2, 12, 12)]


def test_any_twelve_words_in_a_row(spark, docs_of):
    words = [f"w{chr(97 + i)}" for i in range(20)]
    docs = docs_of(*[(at * 100 + n, " ".join(["x", *words[at : at + n], "y"])) for at in range(9) for n in (11, 12)])
    assert hits(docs, table(spark, (1, " ".join(words)))) == sorted(((at * 100 + 12, 1, 12, 20) for at in range(9)), key=str)


def test_every_whole_copy_in_the_given_tables_is_found(spark):
    """Whatever its letter case and punctuation."""
    import re

    folder = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")

    def plain(text):
        return f" {' '.join(re.findall(r'[^\W_]+', text or '')).lower()} "

    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    wanted = {r.item_id: plain(r.text) for r in items.collect()}
    copies = {(d, i) for i, item in wanted.items() for d, text in texts.items() if item in text}
    found = {(r.id, r.item) for r in contaminated(docs, items).collect()}
    assert copies and copies <= found
