"""Column names, lists, markers, limits and prompt wording.

Everything here is part of the data contract, so it is stated as plain text in
its natural order.  Results are only comparable when these values are equal.
"""

# Sentinels.
NOT_FOUND = "NotFound"
NOT_PRESENT = "Not Present"
NOT_AVAILABLE = "NA"

# Limits.
CONTEXT_LINES = 30
CHUNK_LIMIT = 128000
TOC_MARKER = "Sisukord"
TOC_MAX_MISS = 10
STEM_CUT = 2
TOP_LINKS = 3

# Page of origin, anchor name, category.
SECTIONS = [
    ("https://www.riigiteataja.ee/akt/118062014020", "para4", "I"),
    ("https://www.riigiteataja.ee/akt/118062014020", "lg11", "II"),
    ("https://www.riigiteataja.ee/akt/104072014022", "lg5", "III"),
]

# Labels on registry pages.
PLAN_LABEL = "Liigi tegevuskava"
PLAN_LINK_MARK = "getdok"
PLAN_DEFAULT_NAME = "strategy_document"
GROUP_COLUMN = "Rühm"
GROUP_KEPT = "Linnud"
PAGE_CONTAINER = "Body_MiddlePanel"

# Columns of the species list.
LIST_COLUMNS = ["Estonian Name", "Latin Name", "Category"]
LINK_COLUMN = "EELIS link"

# Keys taken from registry pages.
PROFILE_KEYS = [
    "Tüüp",
    "Nimi ladina k",
    "Nimi eesti k",
    "Nimi inglise k",
    "Rühm",
    "Kaitsekategooria",
    "Kirjeldus",
    "Direktiivi lisad",
    "Liigi ohustatuse hinnang",
    "Ohutegurite kirjeldus",
    "Liigi tegevuskava",
    "Kaitsealused alad, kus on kaitse eesmärgiks",
]

# Columns of the enriched list.
PROFILE_COLUMNS = [
    "Estonian Name",
    "Latin Name",
    "Category",
    "EELIS link",
    "strategy_present",
    "strategy_file",
    "Tüüp",
    "Nimi ladina k",
    "Nimi eesti k",
    "Nimi inglise k",
    "Rühm",
    "Kaitsekategooria",
    "Kirjeldus",
    "Direktiivi lisad",
    "Liigi ohustatuse hinnang",
    "Ohutegurite kirjeldus",
    "Liigi tegevuskava",
    "Kaitsealused alad, kus on kaitse eesmärgiks",
]

# Report topics.
TOPICS = [
    "Elupaik",
    "Elupaiga seisund",
    "Ohud",
    "Populatsiooni muutused Eestis",
    "Uuringud",
    "Seisund ELis",
    "Kokkuvõte",
]
WHOLE_TEXT_COLUMN = "Kokkuvõte_text"
FLAG_COLUMN = "Analyze_by_sisukord"

# Summary fields and the topic texts each one is made from.
DESCRIPTION_FIELD = "Kirjeldus (seisund, elupaik, populatsiooni muutused)"
THREAT_FIELD = "Ohutegurite kirjeldus (ohud, elupaiga seisund)"
SUMMARY_FIELDS = [DESCRIPTION_FIELD, THREAT_FIELD]
BUNDLES = {
    DESCRIPTION_FIELD: [
        "Elupaik_text",
        "Populatsiooni muutused Eestis_text",
        "Seisund ELis_text",
    ],
    THREAT_FIELD: ["Elupaiga seisund_text", "Ohud_text"],
}

# Columns of the showcase table.
SHOWCASE_COLUMNS = [
    "Estonian Name",
    "Latin Name",
    "Category",
    "EELIS link",
    "strategy_present",
    "Nimi inglise k",
    "Rühm",
    "Kaitsekategooria",
    DESCRIPTION_FIELD,
    THREAT_FIELD,
]

# Cell texts that a CSV reader takes as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Search query.
SEARCH_QUERY = '"kaitse tegevuskava" "{name}" pdf'

# System messages per request kind.
SYSTEM_MESSAGES = {
    "clean": "You are a helpful assistant that cleans and enhances text extracted with OCR.",
    "passages": "Oled abivalmis assistent, kes aitab teksti analüüsida.",
    "topics_multi": "Oled abivalmis assistent, kes aitab teksti analüüsida ja struktuurida.",
    "topics_single": "Oled abivalmis assistent, kes aitab teksti analüüsida ja struktuurida.",
    "section": "Oled abivalmis assistent, kes aitab ekstraktitud teavet vormindada.",
    "summary": "Oled abivalmis assistent, kes aitab ekstraktitud teavet vormindada.",
}

# Prompt wording per request kind.
PROMPTS = {
    "clean": (
        "This text was detected with OCR and it might contain errors. "
        "Please clean it and update it to be logical:\n\n{text}"
    ),
    "passages": """
        Otsi järgnevas tekstis lõigud, mis on seotud linnuga '{name}', ja kombineeri need.
        Tagasta tulemused ühe tekstina.

        {text}
        """,
    "topics_multi": """Kasutades järgnevat sisukorda:

{toc}

Palun lahenda selle põhjal ja tagasta JSON formaadis, mis osad on seotud linnuga {name} ja järgmiste teemadega:
'Elupaik', 'Elupaiga seisund', 'Ohud', 'Populatsiooni muutused Eestis', 'Uuringud', 'Seisund ELis', 'Kokkuvõte'.

Arvesta, et kui on seotud mitme linnuliigiga käsitletud osad, siis need lisatakse vastavatesse kategooriatesse.
Näiteks lindu 'Hallhani' analüüsides lisatakse ka '3. Ohutegurid'.

Struktuur peaks olla järgmine:
```json
{
   "{name}": [
      {
         "Elupaik": ["2.2.1.1 Elupaiganõudlus"]
      },
      {
         "Elupaiga seisund": ["2.2.1.1 Elupaiganõudlus"]
      },
      {
         "Ohud": ["3. Ohutegurid", "2.2.4 Kaitsestaatus ja senise kaitse tõhususe analüüs"]
      },
      {
         "Populatsiooni muutused Eestis": ["2.2.3.2 Levik ja arvukus Eestis"]
      },
      {
         "Uuringud": [
            "2.2.2 Ülevaade uuringutest ja inventuuridest",
            "2.2.3.1 Levik ja arvukus Euroopas",
            "2.2.3.2 Levik ja arvukus Eestis"
         ]
      },
      {
         "Seisund ELis": ["2.2.3.1 Levik ja arvukus Euroopas"]
      },
      {
         "Kokkuvõte": ["Kokkuvõte"]
      }
   ]
}
```
""",
    "topics_single": """Kasutades järgnevat sisukorda:

{toc}

Palun lahenda selle põhjal ja tagasta JSON formaadis, mis osad on seotud järgmiste teemadega:
'Elupaik', 'Elupaiga seisund', 'Ohud', 'Populatsiooni muutused Eestis', 'Uuringud', 'Seisund ELis', 'Kokkuvõte'.

Struktuur peaks olla nagu nii:
```json
{
   "Lind": [
      {
         "Elupaik": ["8.2.1.1 Elupaiganõudlus"]
      },
      {
         "Elupaiga seisund": ["8.2.1.1 Elupaiganõudlus"]
      },
      {
         "Ohud": ["8.2.3 Kaitsestaatus ja senise kaitse tõhususe analüüs"]
      },
      {
         "Populatsiooni muutused Eestis": ["8.2.2.2 Levik ja arvukus Eestis"]
      },
      {
         "Uuringud": [
            "8.2.2.1 Levik ja arvukus maailmas ja Euroopas",
            "8.2.2.2 Levik ja arvukus Eestis",
            "8.2.3 Kaitsestaatus ja senise kaitse tõhususe analüüs"
         ]
      },
      {
         "Seisund ELis": ["8.2.2.1 Levik ja arvukus maailmas ja Euroopas"]
      },
      {
         "Kokkuvõte": ["Kokkuvõte"]
      }
   ]
}
```
""",
    "section": """
        Otsi järgnevas tekstis lindude jaoks infot teemal: {field}.
        Tagastage võimalikult üksikasjalikud andmed iga parameetri kohta ühtset teksti, kuid mitte rohkem kui 10 lauset. Tagasta kokkuvõte antud teemal või NA kui andmeid ei leidu. Ärge lisage ise mingit teksti.

        {text}
        """,
    "summary": """Otsi järgnevas tekstis kirjed ja vorminda info JSON-struktuurina loendava nimekirjaga (Tagastage võimalikult üksikasjalikud andmed iga parameetri kohta ühtset teksti, kuid mitte rohkem kui 10 lauset):

{text}

Struktuur on järgmine (kui teave puudub tekstis, tagasta 'NA'):
{
  "Kirjeldus (seisund, elupaik, populatsiooni muutused)": "NA",
  "Ohutegurite kirjeldus (ohud, elupaiga seisund)": "NA",
}
""",
}

# Fixed value: the fenced block of a response.
FENCE = r"```json\n([\s\S]*?)\n```"
