"""Which pieces of a text are sentences."""

from postlens.llm import language


def test_sentences_without_a_right_stop():
    lost = ["Wir erwarten mehrere Jahre Erfahrung und idealerweise viel Praxi.s", "Vous aurez à suivre le parcours des nouveaux fournisseurs penda", "Environ 175 personnes comptent sur vous pour les usine.s"]
    others = ["Freelance SAP BW/4HANA Business Analyst (m/f/d)", "What you will do with us here:", "SELECT matnr werks labst FROM mard INTO TABLE @lt_stock", "the very title of this posting here"]
    text = "\n".join([lost[0], others[0], lost[1], *others[1:], lost[2], "Das ist ein ganzer Satz."])
    found = [text[a:b] for a, b in language.sentences(text, "The very title of this posting here")]
    assert found == [*lost, "Das ist ein ganzer Satz."]
