import re

from carelake.llm import surrogates


def swap(text, attempts=None):
    return surrogates.replaced(text, attempts or {})[0]


def test_format_script_and_gender_are_kept():
    new = swap('mail jo.7@post.example.com, call +1 (017) 555-7713, ip 97.51.17.173, token = "04dbebab91ab85687d33"')
    assert re.fullmatch(
        r'mail [a-z]{2}\.\d@[a-z]{4}\.[a-z]{7}\.com, call \+1 \(\d{3}\) \d{3}-\d{4}, '
        r'ip \d{2}\.\d{2}\.\d{2}\.\d{3}, token = "[0-9a-f]{20}"', new
    )
    assert "jo.7@post" not in new and "555-7713" not in new
    new = swap("Maria Lopez and Иван Петров and Ольга Петрова")
    first, man, woman = re.fullmatch(r"(\w+) \w+ and (\w+) \w+ов and (\w+) \w+ова", new).groups()
    assert first in surrogates.GIVEN["latin", "f"] and first != "Maria"
    assert man in surrogates.GIVEN["cyrillic", "m"] and woman in surrogates.GIVEN["cyrillic", "f"]


def test_check_digits_stay_valid():
    new = re.sub(r"\D", "", swap("4111 1111 1111 1111"))
    assert surrogates._luhn(new) == 0 and len(new) == 16


def test_cards_end_where_the_next_number_begins():
    def found(text):
        return [(kind, text[start:end]) for start, end, kind, _ in surrogates.mentions(text)]

    card = ("card", "4283648832092189")
    assert found("4283648832092189 190.137.223.204") == [card, ("ip", "190.137.223.204")]
    assert found("4283648832092189 017 555 7713") == [card, ("phone", "017 555 7713")]
    for text in ["{} 42 items", "17 {}", "1 {} 2", "{}-42", "{} 4111111111111111", "{}"]:
        assert found(text.format(card[1]))[0] == card
    for text in ["4111 1111 1111 1111", "4111-1111-1111-1112", "3782 822463 10005"]:
        assert found(text) == [("card", text)] == found(f"{text} 42 items") == found(f"no 17 {text} 5")
    # Groupings that no card has: the longest with a valid check digit, else all as it stands.
    assert found("41 11111 1111 11111 05") == [("card", "41 11111 1111 11111")]
    assert found("12 34567 8901 23456") == [("card", "12 34567 8901 23456")]


def test_mentions_of_one_entity_get_one_surrogate():
    new = swap("+1 (017) 555-7713 or +1 017 555 7713; A.B@C.ORG a.b@c.org; Mrs. Lopez, Maria Lopez, MARIA")
    one, other = re.match(r"(.*) or (.*?);", new).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", other)
    upper, lower = re.search(r"(\S+@\S+) (\S+@\S+);", new).groups()
    assert upper.isupper() and upper.lower() == lower
    a, b = re.search(r"Mrs\. (\w+), \w+ (\w+)", new).groups()
    assert a == b != "Lopez"


def test_names_found_once_are_replaced_wherever_they_stand():
    text = "Maria Lopez came. Lopez said: maria, MARIA, (LOPEZ) lopez's Maria-Lopez; Lopezia, marias stay."
    new, n = surrogates.replaced(text, {})
    first, last = re.match(r"(\w+) (\w+) came", new).groups()
    assert new == (
        f"{first} {last} came. {last} said: {first.lower()}, {first.upper()}, ({last.upper()}) {last.lower()}'s "
        f"{first}-{last}; Lopezia, marias stay."
    )
    assert n == 9 and first != "Maria" and last != "Lopez"
    new = swap("Maria Martin met Dr. Weiß, WEISS and Martin.")
    assert not re.search("Maria|Martin|Wei", new, re.I)
    assert re.fullmatch(r"(\w+) (\w+) met Dr\. (\w+), (\w+) and \2\.", new)


def test_names_in_capitals_are_found():
    new = swap("MARIA LOPEZ and MRS. PETROVA; JOHN AND THE REST")
    assert not re.search("MARIA|LOPEZ|PETROVA", new) and new.endswith("; JOHN AND THE REST")


def test_further_mentions_leave_other_words_and_entities():
    text = "I saw John. Then then Then. Dr. De Souza, de la"
    assert re.fullmatch(r"I saw \w+\. \w+ then Then\. Dr\. \w+ Souza, de la", swap(text))
    assert re.fullmatch(r"\w+ \w+, [a-z]{5}@[a-z]\.org", swap("Maria Lopez, lopez@x.org"))
    assert swap("Maria Lopez, lopez@x.org")[-11:] == swap("lopez@x.org")


def test_mentions_of_a_name_have_one_entry_and_distinct_surrogates(make):
    docs = make([(1, "Maria Lopez. LOPEZ, maria"), (2, "Mr. Lopez and Lopez"), (3, "lopez alone")])
    found = sorted((r.doc_id, r.kind, r.key) for r in surrogates.entities(docs).collect())
    assert found == [(1, "given", "Maria"), (1, "surname", "lopez"), (2, "surname", "lopez")]
    texts = {r.doc_id: r.text for r in surrogates.pseudonymised(docs).collect()}
    last = re.fullmatch(r"Mr\. (\w+) and \1", texts[2]).group(1)
    assert re.fullmatch(rf"(\w+) {last}\. {last.upper()}, (\w+)", texts[1]) and texts[3] == "lopez alone"


def test_plain_text_is_left_alone(odd):
    for text in ["Licensed under CC BY-NC 4.0. 2.0.", "on 2017-04-01 at 10:30, v1.2.3", "3 of 12 and 1,000", "@ me"]:
        assert swap(text) == text
    for _, text, *_ in odd:
        assert surrogates.replaced(text or "", {}) == (text or "", 0)


def test_digits_of_other_scripts_and_letters_only():
    for text in ["٩١٢٣ ٤٥٦٧ ٨٩٠١ ٢٣٤٥", "abcd:abcd:abcd:abcd:abcd:abcd:abcd:abcd", "PASSWORD: abcdefgh"]:
        assert surrogates.replaced(text, {})[1] == 1


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + " @ " + "1" * 200_000
    assert swap(text) == text


def test_given_names_are_a_permutation():
    for names in surrogates.GIVEN.values():
        assert sorted(surrogates.surrogate("given", n) for n in names) == sorted(names)
        assert all(surrogates.surrogate("given", n) != n for n in names)


def test_collisions_are_resolved_and_distinctness_holds(make):
    # Two-digit-free formats of very few values: most first draws collide.
    rows = [(i, f"write to {c}@x.org or {d}@x.org") for i, (c, d) in enumerate(zip("abcdefghijkl", "mnopqrstuvwx"))]
    docs = make(rows)
    found = surrogates.entities(docs)
    table = {(r.kind, r.key): (r.new, r.attempt) for r in surrogates.registry(found).collect()}
    real = {key for _, key in table}
    new = [v for v, _ in table.values()]
    assert len(table) == 24 and len(set(new)) == 24
    assert not real & set(new)
    assert max(a for _, a in table.values()) > 0
    texts = {r.doc_id: r.text for r in surrogates.pseudonymised(docs).collect()}
    for i, text in rows:
        keys = re.findall(r"\S+@x\.org", text)
        assert texts[i] == f"write to {table['mail', keys[0]][0]} or {table['mail', keys[1]][0]}"


def test_odd_rows_and_empty_table(make, odd):
    rows = surrogates.pseudonymised(make(odd)).collect()
    assert sorted((r.doc_id or -1, r.text) for r in rows) == sorted((d or -1, t or "") for d, t, *_ in odd)
    assert surrogates.pseudonymised(make([])).collect() == []
