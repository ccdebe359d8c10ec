from docweave.llm import pii

DE, GB, NO = "DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947"


def test_accounts_in_running_text(spark):
    """What follows an account number after one space does not hide it, nor belong to it."""
    spaced = "DE89 3704 0044 0532 0130 00"
    cases = [
        (f"{DE} Bank", [DE]), (f"{spaced} BIC COBADEFFXXX", [spaced]), (f"{DE} OK", [DE]), (f"pay {DE} 2024 NOW.", [DE]), (f"{DE} {GB} {NO} A1", [DE, GB, NO]),
        (f"AB12 {DE} Bank", [DE]), (f"IBAN {spaced} 😀 {GB},", [spaced, GB]), (f"😀 中 {GB} Bank", [GB]), (f"x{DE} {DE}x DE00370400440532013000 Bank", []), (f"XX71 {GB}", [GB]), (DE, [DE]), (f"{DE}.", [DE]), ("AB12 " * 300, []),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id int, text string")
    for r in pii.with_spans(docs).collect():
        found = [r.text[s.start : s.end] for s in r.pii if s.kind == "iban"]
        assert found == cases[r.doc_id][1], r.text
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[0] == "[IBAN] Bank" and clean[1] == "[IBAN] BIC COBADEFFXXX" and clean[4] == "[IBAN] [IBAN] [IBAN] A1"
