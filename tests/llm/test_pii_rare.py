import pytest

from threadmill.llm import pii

SPELT = [
    "seven eight nine four three six six", "Seven, Eight, Nine, Four, Three, Six, Six", "nine-eight-seven-six-four-three-six", "sieben acht neun drei vier sechs vier", "SIEBEN ACHT NEUN DREI VIER SECHS VIER",
    "siete ocho tres cuatro seis nueve ocho", "sept huit neuf quatre trois six sept", "fünf vier sechs sieben acht neun drei", "two-two-three four six six seven",
]
GERMAN = ["Hauptstraße", "Hauptstrasse", "Ulmenstr.", "Ulmenstr", "Mühlweg", "Brunnengasse", "Lindenallee", "Marktplatz", "Waldpfad", "Elbufer", "Kurfürstendamm", "Bergsteig", "Havelchaussee"]


@pytest.mark.parametrize("digits", SPELT)
def test_spelt_numbers_of_any_digits(digits):
    text = f"It is {digits}."
    assert [k for _, _, k in pii.spans(text)] == ["phone"]
    assert pii.redact(text) == "It is [PHONE]."


@pytest.mark.parametrize("street", GERMAN)
def test_german_streets_of_any_suffix(street):
    assert pii.redact(f"{street} 12") == "[STREET_ADDRESS]"


def test_few_digit_words_are_no_number():
    assert pii.spans("She counted six, seven and eight; sieben oder acht; siete y ocho.") == []
