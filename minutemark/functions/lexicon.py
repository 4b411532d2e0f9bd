"""Words that tell titles, roles and devices from names, and the accent table."""

from __future__ import annotations

import unicodedata

# ---- Fixed values: the word lists that decide what a label's words are ----

TITLES = """
judge justice honorable honourable hon mayor deputy councillor councilor councilman
councilwoman councilmember councilperson cllr cr commissioner comm chair chairman
chairwoman chairperson vice president trustee alderman alderperson supervisor dr mr
mrs ms miss mx prof rev magistrate marshal sheriff officer sgt sergeant det detective
lt captain capt chief director senator sen rep representative reeve selectman
selectwoman superintendent atty attny attorney ada adas da clerk secretary treasurer
member presiding associate senior assistant asst pro tem ret retired esq aag ausa
""".split()

MISREAD_TITLES = ["judge", "justice", "honorable", "councillor", "councilor", "commissioner", "trustee", "magistrate"]

CLIPPED_TITLES = {"judge": 3, "justice": 4, "councillor": 5, "commissioner": 5}

SUFFIXES = ["jr", "jrs", "sr", "srs", "ii", "iii", "iv"]

SUFFIX_SKELETONS = ["l", "lv", "jr", "sr"]

ROLE_WORDS = """
appellant appellants appellee appellees appelant appelle petitioner petitioners
respondent respondents relator relators plaintiff plaintiffs defendant defendants
intervenor amicus counsel prosecutor prosecution defense defence defender public
state states people county city town township village district borough parish
municipal council committee commission board boardroom courtroom court crt courts
chambers chamber room rooms hall floor podium lectern studio av audio video sound
system systems recording record broadcast stream streaming live meeting meetings
conference planning works police fire library ward office offices department dept
services service legal aid probation pretrial coordinator coordinators reporter
interpreter interpreting translator bailiff staff host cohost admin administrator
moderator zoom webinar panelist presenter speaker participant participants guest
guests user audience visitor caller phone call dial telephone viewer the of and for
at in on to by llc llp inc pc pllc pa corp co company group firm law associates
association university college school schools education unified isd usd authority
agency government gov org com net edu tenth first second third fourth fifth sixth
seventh eighth ninth eleventh twelfth thirteenth fourteenth appeals appellate supreme
circuit division clo cc victim witness jury juror clerks secretary treasurer manager
engineer planner principal teacher student students parent parents community
""".split()

AMBIGUOUS_WORDS = """
chambers hall floor ward law king white may will public court chief clerk mayor
marshal sheriff judge justice bishop parish major deputy park street
""".split()

DEVICE_WORDS = """
iphone ipad ipod galaxy android samsung pixel macbook imac laptop desktop pc
chromebook thinkpad surface dell lenovo hp huawei motorola moto oneplus lg thinq
kindle tablet polycom crestron logitech owl device computer zoomroom zoomrooms
""".split()

DEVICE_ENDINGS = ["iphone", "ipad", "galaxy"]

NO_LABEL = [
    "", "no speaker", "unmute", "mute", "muted", "you", "recording", "stop recording", "screen share",
    "sharing screen", "view options",
]

STATES = ["talking", "speaking", "now speaking", "active speaker"]

PARTICLES = ["mc", "mac", "de", "da", "di", "du", "la", "le", "van", "von", "o", "st"]

SHOWN_TITLES = [
    "judge", "justice", "mayor", "councillor", "councilor", "commissioner", "honorable", "dr", "cr", "trustee",
    "magistrate", "chair",
]

LEAST_KEY, MOST_TOKENS, LONGEST_KEY = 3, 4, 30

# ---- End of the fixed values ----

#: Given names, to tell "Surname, Given" from "Given, Surname": a parameter, with a few common ones as default.
GIVEN_NAMES = """
adam alan alice andrew angela anna anthony barbara brian carol charles christopher daniel david deborah donald dorothy
edward elizabeth emily frank gary george helen ian irma james janet jason jeffrey jennifer jessica john joseph joyce
karen katie kenneth kevin kimberly laura linda lisa margaret maria mark mary matthew melissa michael michelle nancy
nicholas patricia patrick paul peter rebecca richard robert ronald ruth sandra sarah scott sharon stephanie steven susan
thomas timothy uday wade wayne william yolanda
""".split()

_LETTERS = [
    (chr(c), base)
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]
    if len(base := "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))) == 1 and base != chr(c)
]

#: Accented letters and, at the same places, the letters without accents; then the combining accents, which go.
ACCENTED = "".join(a for a, _ in _LETTERS) + "".join(map(chr, range(0x300, 0x370)))
PLAIN = "".join(b for _, b in _LETTERS)
