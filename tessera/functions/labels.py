"""The words and points by which texts and links are classified, in the order in which they are tried."""

from __future__ import annotations

# The words that name each kind, in the order in which kinds are tried.

CAPITAL_METRICS = {
    "statutory_minimum_capital": [
        "minimalni vyse kapitalu", "minimalni vysi kapitalu", "minimalni kapital", "minimalniho kapitalu", "statutory minimum capital",
        "minimum capital requirement",
    ],
    "registered_capital": [
        "zapisovany zakladni kapital", "zapisovaneho zakladniho kapitalu", "zapsany zakladni kapital", "zapsaneho zakladniho kapitalu",
        "splaceny zakladni kapital", "zakladni kapital", "zakladniho kapitalu", "registered capital", "share capital", "subscribed capital",
    ],
    "manager_aum": [
        "aktiva ve sprave skupiny", "majetek ve sprave skupiny", "objem majetku ve sprave spolecnosti", "celkovy objem aktiv ve sprave",
        "assets under management of the group", "total assets under management", "group assets under management",
    ],
    "fund_capital": ["investicni fondovy kapital", "fondovy kapital", "fondoveho kapitalu", "vyse fondoveho kapitalu", "fund capital"],
    "nav": ["net asset value", "hodnota cistych aktiv", "cista hodnota aktiv", "nav"],
    "net_assets": ["cista aktiva", "cistych aktiv", "cisty obchodni majetek", "net assets"],
    "assets_under_management": ["aktiva ve sprave", "majetek ve sprave", "assets under management", "aum"],
    "assets_total": ["celkova aktiva", "aktiva celkem", "total assets", "hodnota majetku fondu", "majetek fondu", "fund assets"],
    "equity": ["vlastni kapital", "vlastniho kapitalu", "equity"],
}
RETURN_SERIES = {
    "kid_scenario": [
        "scenar", "scenare", "stresovy", "neprizniv", "umerny", "prizniv", "performance scenario", "stress scenario", "unfavourable", "unfavorable",
        "moderate scenario", "favourable", "favorable",
    ],
    "annualized_multi_year": [
        "anualizovan", "annualised", "annualized", "prumerne rocni", "prumerny rocni", "average annual", "p.a. za poslednich", "rocne za poslednich",
    ],
    "cumulative": ["kumulativn", "cumulative", "od zalozeni", "od vzniku fondu", "since inception", "celkove zhodnoceni od", "za cele obdobi"],
    "year_to_date": ["ytd", "od zacatku roku", "year to date", "year-to-date"],
    "rolling_12m": [
        "za poslednich 12 mesicu", "poslednich 12 mesicu", "za posledni rok", "mezirocni vykonnost", "meziroc", "rolling 12", "last 12 months",
        "trailing 12", "12m",
    ],
    "calendar_year": [
        "vykonnost v jednotlivych letech", "vykonnost fondu v jednotlivych letech", "vykonnost v letech", "rocni vykonnost", "rocni vynos",
        "vykonnost za rok", "zhodnoceni za rok", "vysledky v jednotlivych letech", "annual performance", "annual return", "calendar year performance",
        "yearly performance",
    ],
}
HISTORICAL_VALUES = {
    "nav_per_share": ["hodnota cistych aktiv na akcii", "cista hodnota aktiv na akcii", "net asset value per share", "navps", "nav na akcii", "nav/akcie"],
    "investment_share_value": [
        "aktualni hodnota investicni akcie", "hodnota investicni akcie", "hodnota jedne investicni akcie", "cena investicni akcie",
        "kurz investicni akcie", "hodnota akcie tridy", "investment share value", "share price",
    ],
    "fund_capital": ["fondovy kapital", "fondoveho kapitalu", "fund capital"],
    "fund_net_assets": ["cista aktiva", "cistych aktiv", "net assets"],
    "aum": ["aktiva ve sprave", "majetek ve sprave", "assets under management", "aum"],
}
FREQUENCIES = {
    "daily": ["denni", "denne", "kazdy pracovni den", "daily"],
    "monthly": ["mesicni", "mesicne", "kazdy kalendarni mesic", "k poslednimu dni kalendarniho mesice", "monthly"],
    "quarterly": ["ctvrtletni", "ctvrtletne", "kvartalni", "quarterly"],
    "annual": ["rocni", "rocne", "kazdorocne", "annual", "yearly"],
}
RETURN_TYPES = {
    "hurdle": ["hurdle rate", "hurdle", "minimalni pozadovana vynosnost", "prekazkova sazba"],
    "preferred": [
        "prednostni vynos", "prednostniho vynosu", "prioritni vynos", "prioritniho vynosu", "preferencni vynos", "preferred return",
        "priority return",
    ],
    "guaranteed_minimum": [
        "garantovany vynos", "garantovane zhodnoceni", "zaruceny vynos", "zarucene zhodnoceni", "minimalni zhodnoceni", "minimalni vynos",
        "minimalni planovane zhodnoceni", "guaranteed return", "guaranteed minimum", "minimum return",
    ],
    "expected": [
        "ocekavany vynos", "ocekavane zhodnoceni", "ocekavana vykonnost", "predpokladany vynos", "predpokladane zhodnoceni", "expected return",
        "expected performance", "anticipated return",
    ],
    "target": [
        "cilovy vynos", "cilove zhodnoceni", "cileny vynos", "cilene zhodnoceni", "cilova vykonnost", "target return", "target yield",
        "targeted return",
    ],
}
BENCHMARK = [
    "2tr", "2t repo", "repo sazb", "repo rate", "pribor", "euribor", "wibor", "sofr", "sazby cnb", "sazbou cnb", "sazba cnb", "inflac", "inflation",
    "benchmark",
]
PERIOD_END = [
    "k poslednimu dni ucetniho obdobi", "k poslednimu dni obdobi", "ke konci ucetniho obdobi", "k rozvahovemu dni", "k datu ucetni zaverky",
    "at the end of the accounting period", "as at the balance sheet date",
]
PER_SHARE = ["na 1 akcii", "na jednu akcii", "na akcii", "na investicni akcii", "na podilovy list", "per share", "na akcii v"]
MANAGER_LEVEL = [
    "skupina spravuje", "spolecnost spravuje", "investicni spolecnost spravuje", "spravcovska spolecnost spravuje", "obhospodarovatel spravuje",
    "ve sprave skupiny", "ve sprave spolecnosti", "aktiva ve sprave skupiny", "majetek ve sprave skupiny", "celkovy objem aktiv ve sprave",
    "napric fondy", "vsechny fondy", "vsech fondu", "our funds", "the group has", "group manages", "company manages", "manager manages",
    "assets under management of the group", "total assets under management",
]
STATUTORY = [
    "nedosahne hranice", "nedosahne vyse", "musi dosahnout", "minimalni vyse kapitalu", "minimalni kapital", "dle ust. § 29", "dle ust. 29",
    "§ 29 odst", "zisif", "must reach", "minimum capital",
]
HORIZON_MINIMUM = ["min.", "min ", "minimalne", "minimalni", "nejmene", "alespon", "a vice", "a delsi", "a dele", "or more", "at least", "minimum"]
COMPONENTS = ["neinvesticni", "neinvesticniho"]
PAST_RETURN = ["vykonnost", "vynos", "zhodnoceni", "vysledek", "vysledky", "return", "performance", "yield"]
#: Wording of a source that publishes no target return.
NOT_PUBLISHED = [
    "cilovy vynos neni stanoven", "cilovy vynos nen", "vynos neni stanoven", "vynos neni garantovan", "nestanovuje cilovy vynos", "nezverejnuje", "neuvadi cilovy vynos",
    "not published", "not disclosed", "no target return",
]
#: Units that stand beside an amount, and addresses of annual reports.
AMOUNT_UNITS = ["tis. kc", "tis.kc", "tisic", "mil. kc", "mil.kc", "milion", "mld"]
ANNUAL_REPORT_ADDRESSES = ["vyrocni", "vyrocka", "/vz_", "vz_", "-vz-", "annual", "zaverka"]
#: Words for the fund itself or for a company in general.
CAPITAL_SUBJECTS = ["fond", "fondu", "fonde", "fondem", "fondy", "podfond", "podfondu", "spolecnost", "spolecnosti", "fund", "subfund"]

#: What a keyword is worth in each place, and the bounds of a decision.
SIGNAL_WEIGHTS = {"document_title": 5, "header_text": 5, "metadata_title": 4, "metadata_subject": 3, "anchor_text": 3, "file_name": 3, "url_path": 2, "page_title": 2, "body_text": 1}
STRONG, WEAK, LEAST, CLOSE = 6, 2, 6, 4
#: Document types: strong keywords, weak ones, pairs that count as a weak one, and words that rule the type out.
DOCUMENT_TYPES = {
    "priips_kid": (
        ["sdeleni klicovych informaci", "key information document", "klicove informace pro investory", "priips", "kiid"],
        ["klicove informace", "klicovych informaci", "kid", "zamysleny retailovy investor", "ukazatel rizika", "summary risk indicator", "co je tento produkt"],
        [], [],
    ),
    "subfund_statute": (["statut podfondu", "subfund statute", "sub-fund statute"], [], [("podfond", "statut")], []),
    "statute": (["statut fondu", "statut investicniho fondu", "fund statute", "uplne zneni statutu"], ["statut", "statute"], [], ["statut podfondu"]),
    "financial_statements": (
        ["ucetni zaverka", "financial statements", "rozvaha", "vykaz zisku a ztraty"],
        ["priloha ucetni zaverky", "balance sheet", "profit and loss"],
        [], [],
    ),
    "half_year_report": (["pololetni zprava", "half year report", "half-year report", "semi annual report", "interim report"], ["pololetni"], [], []),
    "annual_report": (["vyrocni zprava", "annual report", "vyrocni zpravy"], ["vyrocni", "za rok koncici", "for the year ended"], [], ["pololetni zprava"]),
    "prospectus": (["prospekt", "prospectus"], ["base prospectus"], [], []),
    "memorandum": (["investicni memorandum", "information memorandum", "offering memorandum"], ["memorandum"], [], []),
    "price_list": (["cenik", "ceniku", "price list", "sazebnik", "sazebnik poplatku"], ["fee schedule"], [], []),
    "factsheet": (["factsheet", "fact sheet", "informacni list", "produktovy list"], ["prehled fondu", "fund profile"], [], []),
    "infoletter": (
        ["infoletter", "mesicni zprava", "kvartalni zprava", "ctvrtletni zprava", "monthly report", "quarterly report"],
        ["newsletter", "komentar portfolio manazera"],
        [], [],
    ),
    "investor_notice": (
        ["oznameni investorum", "sdeleni akcionarum", "oznameni akcionarum", "investor notice", "notice to investors", "oznameni o zmene"],
        ["pozvanka na valnou hromadu", "zapis z valne hromady"],
        [], [],
    ),
    "register": (["vypis z obchodniho rejstriku", "seznam investicnich fondu"], [], [("obchodni rejstrik", "vypis")], []),
}
#: Pairs of types (first, second) that don't make a decision ambiguous.
REFINEMENTS = [("subfund_statute", "statute"), ("statute", "subfund_statute"), ("half_year_report", "annual_report"), ("financial_statements", "annual_report")]
#: Link rules: type, points, keywords; further keywords add five points each, up to three.
LINK_RULES = [
    ("priips_kid", 120, ["priips", "key information document", "sdeleni klicovych informaci", "klicove informace", "kid dokument", "kid pdf", "kiid"]),
    ("subfund_statute", 100, ["statut podfondu", "subfund statute"]),
    ("statute", 95, ["statut fondu", "statut", "fund statute"]),
    ("memorandum", 90, ["memorandum", "investicni memorandum", "information memorandum", "offering memorandum"]),
    ("financial_statements", 85, ["ucetni zaverka", "financial statements", "financial statement"]),
    ("annual_report", 80, ["vyrocni zprava", "annual report", "annual financial report"]),
    ("half_year_report", 75, ["pololetni zprava", "pololetni report", "half year report", "semi annual report", "interim report"]),
    ("factsheet", 70, ["factsheet", "fact sheet", "informacni list", "produktovy list", "fund sheet"]),
    ("infoletter", 65, ["infoletter", "newsletter", "mesicni zprava", "kvartalni zprava", "monthly report", "quarterly report"]),
    ("other", 45, ["dokumenty", "documents", "ke stazeni", "download center", "pro investory", "for investors"]),
]
LINK_NEGATIVE = [
    "gdpr", "privacy", "cookies", "ochrana osobnich udaju", "kariera", "career", "kontakt", "contact", "fotogalerie", "gallery", "press release", "tiskova zprava",
]
LINK_DOWNLOAD = ["stahnout", "ke stazeni", "download", "soubor", "dokument", "document", "pdf"]
LINK_LEAST = 35
#: Words that a catalogue's names share.
CATALOGUE_GENERIC = [
    "a", "as", "fond", "fund", "fonds", "investicni", "investment", "kapital", "kapitalem", "podfond", "promenneho", "promennym", "promenny", "s", "sicav",
    "spolecnost", "zakladniho", "zakladnim",
]

# Forms before which a fund's name stands, how many words of it, and words that are no name.
FORM_WORDS = ["sicav", "investicni fond", "podfond"]
NAME_REACH = 8
NAME_NOISE = [
    "a", "as", "s", "sicav", "fond", "fund", "fonds", "investicni", "investment", "spolecnost", "podfond", "subfund", "otevreny", "uzavreny", "promennym", "zakladnim",
    "kapitalem",
]
# Words by which a link speaks of a fund, and words of documents in such links.
OTHER_FUND_MARKERS = ["sicav", "podfond", "subfund", "investicni fond", "otevreny podilovy fond", "uzavreny investicni fond"]
DOCUMENT_VOCABULARY = [
    "statut", "statute", "stanovy", "vyrocni", "pololetni", "zprava", "zpravy", "zpravu", "report", "annual", "kid", "kiid", "priips", "klicove", "klicovych", "informace",
    "informaci", "sdeleni", "memorandum", "prospekt", "prospectus", "factsheet", "list", "ucetni", "zaverka", "cenik", "dokument", "dokumenty", "dokumentu", "archiv",
    "trida", "tridy", "tride", "class", "pdf", "download", "soubor", "verze", "aktualni", "platny", "cze", "eng",
]

# How a horizon, a minimum investment and a target return are worded, as pieces of patterns.
HORIZON_WORDS = [
    r"doporucen[ay]?\s+(?:investicni\s+)?(?:horizont|doba\s+drzeni)", r"investicni\s+horizont", r"minimalni\s+doba\s+investice",
    r"recommended\s+holding\s+period", r"investment\s+horizon",
]
HORIZON_UNITS = ["let", "roku", "roky", "years?", "yrs?"]
MINIMUM_STARTS = ["minimalni", "nejnizsi", "minimum", "pocatecni", "initial"]
MINIMUM_SUBJECTS = ["investice", "vklad", "upis", "subscription", "investment"]
RETURN_STARTS = [
    "cilov[ay]", "cilen[ay]", "ocekavan[ay]", "predpokladan[ay]", "prednostn[ei]", "prioritn[ei]", "preferencn[ei]", "garantovan[ay]", "zarucen[ay]", "minimaln[ei]",
    "target", "expected", "anticipated", "preferred", "priority", "guaranteed", "minimum",
]
RETURN_SUBJECTS = ["vynos", "zhodnoceni", "return"]
# Words of rows that state a fee.
FEE_ROW_WORDS = [
    "poplatek", "poplatky", "uplata", "manazersk", "obhospodarov", "vstupni", "vystupni", "vykonnostni", "naklady na vstup", "naklady na vystup", "prubezne naklady",
]
