"""Word lists and patterns that filters and scores must share with the data they were made for.

They are stated here as they are, in their own order, and used nowhere but through the functions of this package.
"""

# Dictionary entries.
META_PREFIXES = ("Template:", "Module:", "Appendix:", "Wiktionary:", "Category:", "Help:", "Special:", "Citations:", "Reconstruction:", "Thesaurus:", "Index:", "Rhymes:", "Concordance:")
EMPTY_TERMS = ("", "-", "—")
ENTRY_HINTS = ("idiomatic", "idiom", "figuratively", "figurative", "metaphoric", "metaphorical", "proverb")
VARIANT_MEANINGS = ("inflection of", "plural of", "alternative form of", "alternative spelling of", "misspelling of", "comparative of", "superlative of", "past tense of", "past participle of", "present participle of")
GOOD_POS = ("phrase", "proverb", "idiom", "verb", "adjective", "adverb", "noun", "interjection")
PHRASE_POS = ("phrase", "idiom", "proverb")

# Strict filter.
STRICT_BAD_POS = ("name", "num", "symbol", "punct", "character", "det", "intj")
STRICT_TAGS = ("idiomatic", "idiom", "figurative", "figuratively", "proverb", "sarcastic", "slang", "informal", "colloquial")
STRICT_BAD_MEANINGS = (r"^initialism of\b", r"^abbreviation of\b", r"^acronym of\b", r"^clipping of\b", r"^ellipsis of\b", r"^alternative form of\b", r"^alternative spelling of\b", r"^misspelling of\b", r"^plural of\b", r"^past tense of\b", r"^past participle of\b", r"^present participle of\b", r"^comparative of\b", r"^superlative of\b", r"^initialism\b", r"^abbreviation\b")

# Cleaning.
CLEAN_BAD_MEANINGS = (r"^used other than figuratively or idiomatically\b", r"^used other than idiomatically\b", r"^used other than figuratively\b", r"^obsolete form of\b", r"^archaic form of\b", r"^alternative form of\b", r"^alternative spelling of\b", r"^misspelling of\b", r"^nonstandard spelling of\b", r"^clipping of\b", r"^ellipsis of\b", r"^abbreviation of\b", r"^initialism of\b", r"^synonym of\b")
CLEAN_BAD_TAGS = ("alt-of", "form-of", "obsolete", "misspelling")
CLEAN_SCORE_TAGS = ("idiomatic", "figurative", "figuratively", "slang", "colloquial", "informal", "proverb")
PRECISE_TAGS = ("idiomatic", "figurative", "figuratively", "proverb")

# Global filter.
GLOBAL_TAGS = ("idiomatic", "idiom", "figurative", "figuratively", "proverb", "slang", "colloquial", "informal", "humorous", "sarcastic", "archaic")
GLOBAL_BAD_MEANINGS = (r"^a .*? (school|college|university|institution|city|country|person|place)\b", r"^the branch of\b", r"^the study of\b", r"^a field of\b", r"^an academic\b", r"^a scientific\b", r"^a kind of\b", r"^a type of\b", r"^a genus of\b", r"^a family of\b", r"^a species of\b", r"^a unit of\b", r"^a measure of\b", r"^a department of\b", r"^a system of\b", r"^a person who\b", r"^a woman who\b", r"^a man who\b", r"^someone who\b")
CURATED_SOURCES = ("phrasefinder", "kaggle_english_idioms")
STRONG_TAGS = ("idiomatic", "figurative", "proverb")
PREPOSITIONS = (" of ", " in ", " on ", " at ", " out ", " up ", " down ", " over ", " under ", " for ", " with ", " by ")
FIGURATIVE_MEANINGS = ("figurative", "idiomatic", "informal", "slang", "colloquial")

# Crowd-sourced slang.
CROWD_BAD_MEANINGS = (r"^a person who\b", r"^someone who\b", r"^a girl who\b", r"^a guy who\b", r"^when\b", r"^the act of\b", r"^an act of\b", r"^used to describe\b", r"^a word used\b", r"^something you say\b", r"^something said\b")
CROWD_TAGS = ("slang", "colloquial", "informal", "modern", "internet", "social media", "viral", "meme")
CROWD_WEAK = ("bro", "sis", "vibe", "mood", "energy", "tea", "shade", "ghost", "cap")
#: Lines of a dictionary page that belong to its controls, and terms that drop an entry of such a page.
PAGE_STOP_LINES = ("share definition", "listen to pronunciation", "flag", "more random definitions", "sign in to vote", "copy link")
PAGE_EXPLICIT = ("porn", "rape", "murder", "suicide", "kill yourself", "nazi", "slur", "racist", "cocaine", "meth", "heroin", "weapon", "gun")
EXPLICIT = ("porn", "rape", "suicide", "kill yourself", "nazi", "racist", "cocaine", "meth", "heroin")

# Dictionary slang.
SLANG_TAGS = ("slang", "informal", "colloquial", "internet", "humorous", "sarcastic", "meme", "vernacular", "nonstandard")
SLANG_BAD_MEANINGS = (r"^alternative spelling of\b", r"^alternative form of\b", r"^misspelling of\b", r"^nonstandard spelling of\b", r"^abbreviation of\b", r"^initialism of\b", r"^acronym of\b", r"^clipping of\b", r"^ellipsis of\b", r"^plural of\b", r"^past tense of\b", r"^past participle of\b", r"^present participle of\b", r"^comparative of\b", r"^superlative of\b", r"^used other than figuratively or idiomatically\b", r"^used other than idiomatically\b", r"^used other than figuratively\b")
SLANG_CLEAN_BAD_MEANINGS = (r"^a person who\b", r"^someone who\b", r"^a woman who\b", r"^a man who\b", r"^a guy who\b", r"^a girl who\b", r"^a boy who\b", r"^a word used\b", r"^a term used\b", r"^something you say\b", r"^something said\b", r"^used to describe\b", r"^used to refer to\b", r"^used when\b", r"^when\b", r"^the act of\b", r"^an act of\b", r"^the state of\b", r"^the process of\b", *SLANG_BAD_MEANINGS)
SLANG_STRONG_TAGS = ("slang", "informal", "colloquial", "internet", "humorous", "sarcastic", "figurative", "figuratively", "idiomatic", "idiom", "meme")
SLANG_WEAK = ("all good", "for real", "my bad", "no way", "you know", "i mean", "kind of", "sort of", "at all", "right now")
GENERIC_WORDS = ("thing", "stuff", "person", "people", "someone", "somebody", "something", "anything", "everything", "state", "process", "act")
PRONOUN_STARTS = ("i ", "you ", "we ", "they ", "he ", "she ")

# Merged modern sources.
MODERN_BAD_MEANINGS = (r"^a person who\b", r"^someone who\b", r"^a woman who\b", r"^a man who\b", r"^a guy who\b", r"^a girl who\b", r"^a word used\b", r"^a term used\b", r"^something you say\b", r"^something said\b", r"^used to describe\b", r"^used to refer to\b", r"^used when\b", r"^when\b", r"^the act of\b", r"^an act of\b", r"^the state of\b", r"^the process of\b", *SLANG_BAD_MEANINGS)
MODERN_TAGS = ("slang", "figurative", "idiomatic", "colloquial", "informal")
MERGE_TAGS = ("slang", "informal", "colloquial", "figurative", "idiomatic")
DICTIONARY_SOURCES = ("wiktionary_slang_kaikki", "urban_dictionary")
DIALOGUE_SOURCE = "opensubtitles_dialogue"
CONFIDENCE = {"high": 3, "medium": 2, "low": 1}
PRIORITY_STAGE_1 = {"wiktionary_slang_kaikki": 3, "kaikki_wiktionary": 3, "urban_dictionary": 1}
PRIORITY_STAGE_2 = {"wiktionary_slang_kaikki": 4, "kaikki_wiktionary": 4, "urban_dictionary": 2, "opensubtitles_dialogue": 1}

# Dialogue phrases.
PRONOUNS = ("i", "you", "we", "he", "she", "they", "it")
STOPWORDS = (
    "a", "an", "the", "and", "or", "but", "if", "of", "to", "in", "on", "at",
    "for", "from", "with", "by", "as", "is", "am", "are", "was", "were", "be",
    "been", "being", "it", "this", "that", "these", "those", "i", "you", "he",
    "she", "we", "they", "me", "him", "her", "us", "them", "my", "your", "his",
    "their", "our", "so", "just", "very", "too", "not", "no", "yes", "do", "did",
    "does", "have", "has", "had", "will", "would", "can", "could", "shall",
    "should", "may", "might", "must", "all", "any", "some", "one", "two", "three",
    "then", "than", "here", "there", "now", "well", "also", "only", "even", "still",
)
#: Mining has "backfire"; the later stages have "rip" instead.
MINING_CUES = (
    "get", "give", "take", "keep", "cut", "lose", "make", "play", "come", "go",
    "back", "over", "off", "out", "down", "up", "through", "around", "away",
    "mind", "break", "slack", "point", "deal", "catch", "mean", "mess", "hang",
    "blow", "fall", "pull", "push", "drag", "drop", "sell", "buy", "call", "turn",
    "hold", "bring", "throw", "pick", "run", "work", "stick", "hit", "cool", "save",
    "snap", "shut", "spill", "burn", "move", "read", "ride", "backfire", "flip",
)
CUES = (
    "get", "give", "take", "keep", "cut", "lose", "make", "play", "come", "go",
    "back", "over", "off", "out", "down", "up", "through", "around", "away",
    "mind", "break", "slack", "point", "deal", "catch", "mean", "mess", "hang",
    "blow", "fall", "pull", "push", "drag", "drop", "sell", "buy", "call", "turn",
    "hold", "bring", "throw", "pick", "run", "work", "stick", "hit", "cool", "save",
    "snap", "shut", "spill", "burn", "move", "read", "ride", "flip", "rip",
)
PARTICLES = ("up", "down", "off", "out", "over", "away", "around", "back", "through")
MINING_WEAK_WORDS = ("thing", "stuff", "person", "people", "someone", "somebody", "something", "anything", "everything", "nothing", "time", "place", "way", "kind", "sort")
WEAK_WORDS = (*MINING_WEAK_WORDS, "part", "side", "moment", "minute", "day", "night", "man", "woman")
MINING_BLOCKED = (
    "thank you", "thanks a lot", "excuse me", "good morning", "good night", "see you later", "see you soon", "yes sir",
    "no sir", "oh my god", "come on", "let's go", "shut up", "i don't know", "i do not know", "you know what",
    "what are you doing", "what do you mean", "where are you going", "how are you", "i love you", "i miss you",
    "leave me alone", "get out of here", "what's going on", "right now", "at all", "a lot of", "one of the",
    "in the middle", "at the same", "i have to", "we have to", "you have to", "do you want", "do you know",
    "what do you think", "as soon as", "at the end", "at the time", "in the end", "on the other", "for the first",
    "for the last", "there you go", "here we go", "all right now", "what is this", "who is that", "how do you",
    "why do you",
)
BLOCKED_STARTS = (
    "i want ", "i need ", "i have ", "i had ", "i was ", "i am ", "you want ", "you need ", "you have ", "you had ",
    "you were ", "you are ", "we want ", "we need ", "we have ", "we had ", "he was ", "she was ", "they were ",
    "it was ", "there is ", "there are ", "this is ", "that is ", "what is ", "who is ", "why is ", "how is ",
    "do you ", "can you ", "will you ", "would you ", "did you ", "are you ", "have you ",
)
LITERAL_STARTS = (
    "go to ", "come to ", "walk to ", "drive to ", "open the ", "close the ", "pick up ", "put it ", "take the ",
    "sit on ", "look at ", "talk to ", "wait for ", "work on ", "call the ", "bring the ", "leave the ", "hold the ",
)
MINING_LITERAL_STARTS = (
    "go to ", "come to ", "walk to ", "drive to ", "open the ", "close the ", "pick up ", "put it ", "take the ",
    "sit on ", "look at ", "talk to ", "come with ", "wait for ", "work on ", "call the ", "bring the ", "leave the ", "hold the ",
)
WEAK_PHRASES = (
    "how are you", "where are you", "what are you", "what do you", "do you know", "do you want", "can you help",
    "can you see", "i need you", "i want you", "i love you", "i miss you", "let me go", "come with me", "look at me",
    "talk to me", "wait for me", "go with him", "what is that", "what is this", "who is that", "who is this",
    "there you are", "here you are", "here we are", "at the end", "in the end", "at this point", "for the first",
    "for the last", "one of them", "one of us",
)
MODERN_WEAK_PHRASES = (*WEAK_PHRASES, "a lot of", "one of the", "in the middle", "at the same", "right now", "at all")
SCAFFOLDS = (
    r"^(?:(?:there|this|that|what|who|why|how)\s+\w+\s+\w+\b|(?:do|did|can|will|would|are|have)\s+you\s+\w+\b)"
)
MINING_SCAFFOLDS = r"^(?:(?:i|you|we|he|she|they|it)\s+\w+\s+(?:to|the|a|an|my|your|his|her|our|their)\b|(?:there|this|that|what|who|why|how)\s+\w+\s+\w+\b|(?:do|did|can|will|would|are|have)\s+you\s+\w+\b)"
STRONG_PATTERNS = (
    r"\bget\b.*\bover\b",
    r"\bgive\b.*\bup\b",
    r"\bmake\b.*\bup\b",
    r"\bcut\b.*\bslack\b",
    r"\bblow\b.*\boff\b",
    r"\bhang\b.*\bout\b",
    r"\bback\b.*\boff\b",
    r"\bshut\b.*\bup\b",
    r"\bkeep\b.*\bup\b",
    r"\blose\b.*\bmind\b",
    r"\bcatch\b.*\bup\b",
    r"\bfall\b.*\bapart\b",
    r"\bpull\b.*\boff\b",
    r"\bwork\b.*\bout\b",
    r"\bcome\b.*\bthrough\b",
    r"\bturn\b.*\bdown\b",
    r"\bturn\b.*\bup\b",
    r"\bstick\b.*\bout\b",
    r"\bcall\b.*\boff\b",
)
#: The merged filter leaves out "shut ... up".
MODERN_STRONG_PATTERNS = (
    r"\bget\b.*\bover\b",
    r"\bgive\b.*\bup\b",
    r"\bmake\b.*\bup\b",
    r"\bcut\b.*\bslack\b",
    r"\bblow\b.*\boff\b",
    r"\bhang\b.*\bout\b",
    r"\bback\b.*\boff\b",
    r"\bkeep\b.*\bup\b",
    r"\blose\b.*\bmind\b",
    r"\bcatch\b.*\bup\b",
    r"\bfall\b.*\bapart\b",
    r"\bpull\b.*\boff\b",
    r"\bwork\b.*\bout\b",
    r"\bcome\b.*\bthrough\b",
    r"\bturn\b.*\bdown\b",
    r"\bturn\b.*\bup\b",
    r"\bstick\b.*\bout\b",
    r"\bcall\b.*\boff\b",
)


# Enriched rows.
MAIN_LABELS = ("idiomatic", "literal")
LABELS = ("idiomatic", "literal", "borderline")
ROW_TYPES = ("main_example", "adversarial_example_1", "adversarial_example_2")
CONTEXTS = ("dialogue", "narrative", "formal", "social_media", "question", "sarcastic")
STYLES = tuple(f"synthetic_{c}" for c in (*CONTEXTS, "adversarial"))
ADVERSARIAL_TYPES = ("negation", "partial_overlap", "contrastive_context", "literal_trap", "figurative_trap", "borderline_ambiguity")
