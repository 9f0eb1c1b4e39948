"""Fixed word lists and small seed lexicons.

The lists are plain text so that they can be read and replaced; the lexicons
are seeds for tests and first runs. A full lexicon is a table the user brings.
"""

from __future__ import annotations

# The English stop word list (public, 179 words).
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# The default English stop words of the search analyser.
SEARCH_STOP_WORDS = """
a an and are as at be but by for if in into is it no not of on or such that the
their then there these they this to was will with
""".split()

# Cell texts that mean "no value" in a CSV file.
NULL_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Nouns whose singular the suffix rules of ``lemma_rules`` would get wrong.
IRREGULAR_NOUNS = {
    "men": "man", "women": "woman", "policemen": "policeman", "firemen": "fireman", "businessmen": "businessman",
    "salesmen": "salesman", "gentlemen": "gentleman", "fishermen": "fisherman", "workmen": "workman",
    "spokesmen": "spokesman", "sportsmen": "sportsman", "congressmen": "congressman", "freshmen": "freshman",
    "craftsmen": "craftsman", "policewomen": "policewoman", "businesswomen": "businesswoman", "children": "child", "feet": "foot",
    "teeth": "tooth", "geese": "goose", "mice": "mouse", "lice": "louse",
    "oxen": "ox", "wolves": "wolf", "knives": "knife", "lives": "life",
    "wives": "wife", "leaves": "leaf", "halves": "half", "thieves": "thief",
    "shelves": "shelf", "calves": "calf", "loaves": "loaf", "elves": "elf",
    "buses": "bus", "viruses": "virus", "bonuses": "bonus", "campuses": "campus",
    "movies": "movie", "cookies": "cookie", "zombies": "zombie",
    "selfies": "selfie", "headaches": "headache", "news": "news",
    "series": "series", "species": "species", "always": "always",
    "perhaps": "perhaps", "analyses": "analysis", "crises": "crisis",
    "heroes": "hero", "potatoes": "potato", "tomatoes": "tomato", "echoes": "echo",
}

# Words that end in s and are no plurals, beyond those in -ss, -us, -is and -ics.
SINGULAR_S = """
lens bias gas atlas canvas alias thanks chaos pancreas christmas texas kansas mars atlas alas yes whereas besides
sometimes towards afterwards upwards downwards forwards backwards outdoors indoors nowadays perhaps always news
series species means headquarters crossroads gallows mathematics ethos pathos cosmos asbestos rhinoceros iris
abs gps dos james charles thomas lucas nicholas andreas athens brussels wales netherlands
""".split()

# Frequent function words per language, for language id without a profile.
LANGUAGE_WORDS = {
    "de": "der die das und ist nicht ich sie ein eine mit auf den dem zu von im "
          "auch es an werden aus er hat dass wie bei oder aber nur nach".split(),
    "en": "the of and to in is that it was for on are with as his they this be at "
          "have from or had by but not what were we when your can you an my i".split(),
    "es": "el la de que y en los se del las por un para con una su al lo como pero "
          "sus le ya o este porque esta entre cuando muy sin sobre".split(),
    "fr": "le la les de des du un une et est en que qui dans ce pour pas sur au il "
          "avec ne se plus par je ceci cette vous nous sont mais".split(),
    "it": "il di che e la per un in non sono una mi con si ho lo ma ha cosa le ti "
          "della del questo anche come da al gli".split(),
}

# Seed of valence terms (-4 to 4).
VALENCE = {
    "love": 3.2, "loved": 2.9, "lovely": 2.8, "amazing": 2.8, "awesome": 3.1,
    "fantastic": 2.6, "wonderful": 2.7, "great": 3.1, "good": 1.9, "nice": 1.8,
    "happy": 2.7, "best": 3.2, "better": 1.9, "beautiful": 2.9, "excellent": 2.7,
    "perfect": 2.7, "fun": 2.3, "funny": 1.9, "friend": 2.2, "friendly": 2.2,
    "kind": 2.4, "thanks": 1.9, "thank": 1.5, "like": 1.5, "enjoy": 2.2,
    "smile": 1.5, "support": 1.7, "respect": 2.1, "brave": 2.4, "proud": 2.1,
    "hate": -2.7, "hated": -3.2, "terrible": -2.1, "awful": -2.0,
    "horrible": -2.5, "bad": -2.5, "worst": -3.1, "worse": -2.1, "ugly": -2.3,
    "stupid": -2.4, "dumb": -2.3, "idiot": -2.3, "loser": -2.4, "sad": -2.1,
    "angry": -2.3, "kill": -3.7, "die": -2.9, "bully": -2.2, "bullying": -2.9,
    "harass": -2.2, "harassment": -2.5, "threat": -2.4, "hurt": -2.4,
    "pain": -2.3, "cry": -2.1, "shame": -2.1, "disgusting": -2.4, "evil": -3.4,
    "fail": -2.5, "liar": -2.3, "no": -1.2, "urgent": 0.8,
}

# Degree words. "+" raises a neighbour's valence, "-" lowers it.
BOOSTERS = {
    "+": """
absolutely amazingly awfully completely considerable considerably decidedly
deeply effing enormous enormously entirely especially exceptional exceptionally
extreme extremely fabulously flipping flippin frackin fracking fricking frickin
frigging friggin fully fuckin fucking fuggin fugging greatly hella highly hugely
incredible incredibly intensely major majorly more most particularly purely
quite really remarkably so substantially thoroughly total totally tremendous
tremendously uber unbelievably unusually utter utterly very
""".split(),
    "-": """
almost barely hardly kinda kindof less little marginal marginally occasional
occasionally partly scarce scarcely slight slightly somewhat sorta sortof
""".split(),
}
BOOST = 0.293

# Negations.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't
daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't
hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor
not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't
shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom
despite
""".split()

# Words that have a part of their own in the valence rules.
VALENCE_ROLES = {
    "but": "but", "never": "never", "so": "so", "this": "so", "without": "without",
    "doubt": "doubt", "least": "least", "at": "at", "very": "at", "no": "no",
    "or": "or", "nor": "or", "kind": "kind", "of": "of",
}

# Phrases with a valence of their own, and phrases that lower a neighbour's.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0,
    "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
LOWERING_PHRASES = ["kind of", "sort of", "just enough"]

# Seed of polarity terms as (polarity, subjectivity, intensity).
POLARITY = {
    "love": (0.5, 0.6, 1.0), "loved": (0.7, 0.8, 1.0), "lovely": (0.5, 0.75, 1.0),
    "amazing": (0.6, 0.9, 1.0), "awesome": (1.0, 1.0, 1.0),
    "fantastic": (0.4, 0.9, 1.0), "wonderful": (1.0, 1.0, 1.0),
    "great": (0.8, 0.75, 1.0), "good": (0.7, 0.6, 1.0), "nice": (0.6, 1.0, 1.0),
    "happy": (0.8, 1.0, 1.0), "best": (1.0, 0.3, 1.0), "better": (0.5, 0.5, 1.0),
    "beautiful": (0.85, 1.0, 1.0), "excellent": (1.0, 1.0, 1.0),
    "perfect": (1.0, 1.0, 1.0), "fun": (0.3, 0.2, 1.0), "funny": (0.25, 1.0, 1.0),
    "kind": (0.6, 0.9, 1.0), "brave": (0.8, 1.0, 1.0), "proud": (0.8, 1.0, 1.0),
    "hate": (-0.8, 0.9, 1.0), "hated": (-0.9, 0.7, 1.0),
    "terrible": (-1.0, 1.0, 1.0), "awful": (-1.0, 1.0, 1.0),
    "horrible": (-1.0, 1.0, 1.0), "bad": (-0.7, 0.667, 1.0),
    "worst": (-1.0, 1.0, 1.0), "worse": (-0.4, 0.6, 1.0), "ugly": (-0.7, 1.0, 1.0),
    "stupid": (-0.8, 1.0, 1.0), "dumb": (-0.375, 0.5, 1.0),
    "idiot": (-0.8, 0.8, 1.0), "sad": (-0.5, 1.0, 1.0), "angry": (-0.5, 1.0, 1.0),
    "disgusting": (-1.0, 1.0, 1.0), "evil": (-1.0, 1.0, 1.0),
    "very": (0.2, 0.3, 1.3), "really": (0.2, 0.2, 1.3),
    "extremely": (-0.125, 1.0, 1.3), "totally": (0.0, 0.75, 1.3),
    "absolutely": (0.2, 0.9, 1.3), "slightly": (-0.167, 0.167, 0.5),
}

# Words of the table above that change the next one, and negations.
POLARITY_MODIFIERS = ["very", "really", "extremely", "totally", "absolutely", "slightly"]
POLARITY_NEGATIONS = ["no", "not", "n't", "never"]
