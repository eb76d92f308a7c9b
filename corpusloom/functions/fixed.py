"""Fixed values that results depend on: word lists, tables and patterns, as plain text."""

# Words that may not stand at the edge of a phrase.
PHRASE_STOP = """a an and are as at be been but by for from had has have he her his i if in is it its me my not of on or our so that the their them they this to was we were will with you your today just amp rt via more all can out now new one get make than about what when who how why up down over under after before during their there here going day says said join watch live tune proud great thank thanks happy im dont its lets us do does did done shall would could should might must""".split()

# Words without weight in evidence queries.
QUERY_STOP = """a an the and or but of to in on at for from by with as is are was were be been this that these those it its into over under about after before during than then there their they them we our you your he she his her him not no yes do does did have has had will would can could should may might just also more most very so up out if when where which who whom whose what why how all any some such only own same too s t d ll re ve m today tonight yesterday tomorrow week day new year years month months time times way thing things lot one two happy wishing everyone celebrating""".split()

# Capitalised words that are no distinctive names.
GENERIC_WORDS = """good great big new old day night morning evening time people home family families health care year week weekend month first last next today work jobs job right left way life world country state city county town community national public private local school schools students teachers workers women men children kids veterans seniors small business businesses party election elections campaign candidate candidates primary midterm midterms budget tax taxes money cost costs price prices economy energy climate water air land safety justice freedom democracy rights law laws order power plan plans policy fund funds funding report reports news story stories history future every everyone thank thanks proud honored honor join joined happy congratulations welcome update breaking live watch read listen important love support fight fighting protect protecting defend stand together forward strong safe free fair decision decisions emergency open close security now here there again never always recent general inside make""".split()

# Names too common to be distinctive.
COMMON_NAMES = """house senate congress congressional democrats democrat democratic republicans republican gop trump donald don potus flotus biden joe joseph harris kamala vance jd president presidential presidency white washington capitol american americans america united states u.s us federal government administration bill act vote court supreme committee speaker leader rep sen monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december""".split()

# Verbs and connecting words that are no subject.
SUBJECT_FILLER = """recent like really real make made making sure say says said saying told tell tells ask asks asked call calls called come comes came coming go goes going went get gets got getting means mean show shows showing serve serving sent back stop around across together take takes taking done complete nothing something anything everything much many several need needs needed held hold having happen happens happening happened seriously just again still also even whether would could should might must put puts putting end ends ending ended role roles effort efforts absolutely gotten give gives given think thinks""".split()

# Named entities that text is decoded from.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“", "mdash": "—", "ndash": "–", "hellip": "…"}

# Incident kinds, by the first pattern that matches.
KINDS = [
    ("active shooter", "active shooter"),
    ("shoot|gunfire|gunman|shots? fired", "shooting"),
    ("hazmat|chemical|toxic|gas leak|hazardous", "hazmat"),
    ("water (outage|main|boil|contamination)|boil[- ]water", "water outage"),
    ("outage|blackout", "power outage"),
    ("house fire|structure fire|apartment fire|building fire|residential fire", "structure fire"),
    ("wildfire|brush fire|forest fire|grass fire|\\bfires?\\b|blaze", "wildfire"),
    ("flood|heavy rain", "flooding"),
    ("tornado", "tornado"),
    ("hurricane|tropical storm|typhoon|cyclone", "hurricane"),
    ("storm|severe weather|derecho|high wind|wind damage", "severe storm"),
    ("heat", "extreme heat"),
    ("plane|aircraft|aviation|helicopter|jet crash", "plane crash"),
    ("train|rail|derail", "train crash"),
    ("explosion|blast", "explosion"),
    ("missing", "missing persons"),
    ("bridge|dam (failure|breach)|infrastructure|collapse|water main", "infrastructure failure"),
    ("industrial|plant|refinery|factory", "industrial accident"),
    ("earthquake|quake", "earthquake"),
]

# Words of a kind that say nothing about it, and words that say the same.
KIND_MODIFIERS = "severe extreme major active mass heavy widespread large big deadly fatal flash tropical multi vehicle damage incident event emergency disaster release situation persons person people failure accident other landfall recovery warning advisory wave".split()
KIND_SYNONYMS = {
    "wildfire": "fire blaze burn", "fire": "blaze wildfire", "fires": "blaze wildfire", "flooding": "flood floodwater", "flood": "flooding floodwater",
    "shooting": "shot shots gunfire gunman shooter", "shooter": "shot shots gunfire gunman shooting", "hazmat": "chemical hazardous", "chemical": "hazmat",
    "crash": "collision collided crashed overran derail", "collision": "crash collided", "outage": "outages blackout power", "explosion": "blast exploded",
    "earthquake": "quake", "hurricane": "storm", "heat": "heatwave", "leak": "spill", "plane": "aircraft jet flight", "train": "rail derail",
    "storm": "storms", "weather": "storm storms", "missing": "search",
}

# Words of a place name that name no place by themselves.
PLACE_GENERIC = "county counties city town area areas region island islands district northwest southeast northeast southwest eastern western northern southern north south east west central greater metro downtown and of the near valley".split()

# States and their postal codes.
STATE_NAMES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado",
    "CT": "connecticut", "DE": "delaware", "DC": "district of columbia", "FL": "florida", "GA": "georgia", "HI": "hawaii",
    "ID": "idaho", "IL": "illinois", "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky",
    "LA": "louisiana", "ME": "maine", "MD": "maryland", "MA": "massachusetts", "MI": "michigan", "MN": "minnesota",
    "MS": "mississippi", "MO": "missouri", "MT": "montana", "NE": "nebraska", "NV": "nevada", "NH": "new hampshire",
    "NJ": "new jersey", "NM": "new mexico", "NY": "new york", "NC": "north carolina", "ND": "north dakota", "OH": "ohio",
    "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania", "RI": "rhode island", "SC": "south carolina", "SD": "south dakota",
    "TN": "tennessee", "TX": "texas", "UT": "utah", "VT": "vermont", "VA": "virginia", "WA": "washington",
    "WV": "west virginia", "WI": "wisconsin", "WY": "wyoming", "PR": "puerto rico", "GU": "guam", "VI": "virgin islands",
    "AS": "american samoa", "MP": "northern mariana islands",
}

# Cues that keep a post, and cues that set one aside, by reason.
_NUM = "(?:\\d+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|fifteen|twenty|twenty-five|thirty|fifty|a hundred)"
_EVENT = "(?:storms?|floods?|flooding|fires?|wildfires?|tornado(?:es)?|hurricane|derecho|earthquake|shooting|disaster)"
_MONTH = "(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept?|oct|nov|dec)"
LIVE_CUES = [
    "\\bevacuat", "\\bshelter", "\\bhotline\\b", "\\bcall\\s*\\(?\\d{3}\\b", "\\b\\d{3}[-.)\\s]\\s?\\d{3}[-.\\s]\\d{4}\\b",
    "\\b(?:avoid|stay (?:away from|out of|clear of)) the area\\b",
    "\\b(?:road|roads|highway|hwy|bridge|street|lanes?|interstate|i-\\d+|route|freeway)\\b[^.!?]{0,40}\\b(?:closed|closure|closures|shut)\\b",
    "\\bactive shooter\\b", "\\bshots fired\\b", "\\bmissing\\b", "\\boutages?\\b", "\\bpower (?:is )?out\\b", "\\b911\\b",
    "\\brescue", "\\bunder ?way\\b", "\\bright now\\b", "\\beffective immediately\\b", "\\ball[- ]clear\\b",
    "\\breport (?:storm |any |flood |property )?damage\\b", "\\bdamage (?:report|assessment)",
    "\\bmy (?:office|team|staff)\\b", "\\bin (?:direct |close |constant )?(?:contact|communication|touch) with\\b", "\\bon the ground\\b", "\\bon scene\\b",
    "\\bwarning for zone\\b", "\\border for zone\\b", "\\bleave (?:now|immediately|without delay)\\b",
]
FILTER_CUES = {
    "commemoration": [
        "\\banniversar(?:y|ies)\\b", f"\\b{_NUM} (?:years?|decades?) (?:ago|since|later|on)\\b", "\\byears? (?:since|after) the\\b",
        "\\b(?:we|to|let'?s|always|forever|today we|as we|join me in|take a moment to) remember\\b",
        "\\bremember(?:ing)? (?:the|those|all|our|when|him|her|them|everyone|lives|victims)\\b", "\\bin (?:loving )?memory\\b", "#neverforget\\b",
        "\\bnever forget\\b", "\\bmemorial (?:service|ceremony|day|for)\\b", "\\bhonor(?:ing)? the (?:memory|memories|victims|lives)\\b",
    ],
    "hypothetical": [
        "\\bwhat if\\b", "\\bimagine\\b", "\\bhypothetical", "\\bscenario\\b", "\\b(?:drill|tabletop exercise|simulation|simulated|mock)\\b",
        "\\bif (?:a|an|another) [a-z' -]{0,30}(?:hits?|strikes?|happens?|were to|comes?|struck)\\b",
        "\\bcould (?:happen|strike|hit) (?:here|anywhere|again)\\b", f"\\bwhen (?:the next|a|another) {_EVENT}\\b",
    ],
    "dated past": [
        f"\\b{_NUM} (?:weeks|months) ago\\b", "\\b(?:last|this past|earlier this) (?:month|year|summer|spring|winter|fall|autumn)\\b",
        f"\\bthe {_MONTH}\\.?(?: and {_MONTH}\\.?)? (?:severe |devastating |historic )?{_EVENT}\\b", "\\bspent (?:months|weeks|years)\\b",
        "\\bapply by\\b", "\\b(?:application|filing|registration) deadline\\b", "\\bdeadline to (?:apply|register|file)\\b",
    ],
    "aftermath": [
        f"\\b{_EVENT} recovery\\b", "\\bcontinues? to recover\\b", "\\brecovering from\\b", "\\baftermath of\\b", "\\bleft behind\\b",
        "\\b(?-i:storm|hurricane|[A-Z][a-z]+) (?-i:is gone)\\b", "\\bpicking up the pieces\\b", "\\bdisaster declaration\\b",
        "\\b(?:fema|sba|usda) (?:assistance|aid|help|application|deadline|disaster)\\b", "\\bassistance may be available\\b",
        "\\bintake cent(?:er|re)\\b", "\\bdaily (?:storm |flood |fire )?update\\b",
    ],
    "seasonal or preparedness": [
        "\\bpreparedness\\b", "\\b(?:hurricane|wildfire|fire|tornado|storm|flood) season\\b", "\\b(?:emergency|disaster|go) kit\\b",
        "\\bprepar(?:e|ing) (?:now|early|ahead|your (?:family|home|kit))\\b",
    ],
}
REACTION_OPENER = "^(?:what a tragedy|(?:i am |i'm |we are |we're |so |absolutely |deeply |truly )?(?:heartbroken|horrified|devastated|saddened|praying|mourning)|(?:my|our) (?:thoughts|hearts?|prayers)|thoughts and prayers|sending (?:love|prayers|strength)|it is (?:devastating|heartbreaking)|rest in (?:peace|power))\\b"
