"""One entity keeps one surrogate in every spelling, and different ones stay apart."""

import re

from mentionlake.llm import surrogates

KEY = b"k"


def new(kind, value):
    return surrogates.surrogate(KEY, kind, value)


def test_spellings_of_a_phone_number_agree():
    spaced, bare = new("phone", "+1 826 555 4081"), new("phone", "+18265554081")
    assert re.sub(r"\D", "", spaced) == re.sub(r"\D", "", bare) and spaced.startswith("+1 ") and bare != "+18265554081"
    assert new("phone", "+49 30 1234567").startswith("+49 ") and new("phone", "+353 1 234 5678").startswith("+353 ")


def test_names_keep_family_gender_and_script():
    full, short, other = new("person", "Mr Alex Kim"), new("person", "Mr Kim"), new("person", "Mrs Joan Kim")
    assert full.split()[-1] == short.split()[-1] == other.split()[-1] != "Kim"
    assert full.split()[1] in surrogates.GIVEN["m", "latin"] and other.split()[1] in surrogates.GIVEN["f", "latin"]
    assert new("person", "г-жа Анна Петрова").split()[1] in surrogates.GIVEN["f", "cyrillic"]
    assert new("person", "Dr Maria Smith").split()[1] in surrogates.GIVEN["f", "latin"]
    for value in ("Mr Դավիթ Պետրոսյան", "Prof. דוד לוי", "Κύριος Νίκος Παππάς"):
        out = new("person", value)
        assert [ord(a[0]) >> 8 for a in out.split()] == [ord(a[0]) >> 8 for a in value.split()] and out != value


def test_found_behind_titles_of_all_kinds():
    for text in ("Dr Jane Roe", "Miss Roe", "Prof. Roe", "г-н Иванов", "госпожа Анна Петрова", "κυρία Παππά", "Mme Dupont"):
        assert [(k, v) for _, _, k, v in surrogates.entities(f"so {text}, then")] == [("person", text)]
    assert list(surrogates.entities("the doctor said so, mr nobody")) == []


def test_families_and_numbers_stay_distinct_over_a_corpus(spark):
    names = [f"N{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    texts = [f"Mr Carl {n} met Mrs {n}. Call +1 826 555 {i:04d} or +1826555{i:04d}." for i, n in enumerate(names)]
    texts += ["Mr Fischer", "Mrs Weber", "Dr Emma Turner"]
    rows = surrogates.replaced(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "k")
    got = {r["doc_id"]: r["text"] for r in rows.collect()}
    family = []
    for i in range(400):
        a, b, p, q = re.fullmatch(r"Mr \S+ (\S+) met Mrs (\S+)\. Call (\+1 [\d ]+) or (\+1\d+)\.", got[i]).groups()
        assert a == b and p.replace(" ", "") == q
        family.append(a)
    assert len(set(family)) == 400 and not set(family) & {*names, "Fischer", "Weber", "Turner"}
    assert len({t[-11:] for t in list(got.values())[:400]}) == 400
