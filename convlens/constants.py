"""Fixed values that decide results. All are stated plainly, in natural order."""

# Words, and the white space between them (Unicode white space
# and the four ASCII separators).
WORD = r"(?U)[^\s\x{1c}-\x{1f}]+"
WHITE_SPACE = r"(?U)[\s\x{1c}-\x{1f}]+"
OUTER_SPACE = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
NOT_BLANK = r"(?U)[^\s\x{1c}-\x{1f}]"

# Cleaning patterns.
TAG = "<[^>]*>"
EMOTICON = r"[:;=]-?[)(DP]"
NON_WORD = r"[^\p{L}\p{N}_]+"

# Role markers of a flattened conversation.
USER_MARK = "__ROLE_USER__"
ASSISTANT_MARK = "__ROLE_ASSISTANT__"

# Redacted-name token.
NAME_TOKEN = "NAME_[0-9]+"

# Token patterns of the two exploratory tokenisers and of TF-IDF.
LETTERS_TOKEN = "[A-Za-z']{2,}"
LOWER_TOKEN = "[a-z][a-z']+"
TERM_TOKEN = r"[\p{L}\p{N}_]{2,}"

# CJK range of the language guess.
CJK = r"[\x{4E00}-\x{9FFF}]"

# Words ignored by the letters tokeniser.
LETTERS_STOP = (
    "a an the and or but if then else of to in on at by for with from as is "
    "are was were be been being have has had do does did this that these those it its "
    "i you he she we they me him her us them my your his their our not no yes can "
    "could should would will may might shall just so very also more most than into "
    "about over under up down out off there here what which who whom whose how why "
    "when where any all some such only own same other another any's same's"
).split()

# Words ignored by the lower-case tokeniser.
LOWER_STOP = (
    "the a an of to in and or for is are was were be been being on at by with from as "
    "that this it its his her their our your you i we they he she them me my so but not "
    "no if then than into about over under up down out do does did has have had can could "
    "should would may might will just also more most less few many much such only own "
    "same other some any all one two three new"
).split()

# English stop words of the old cleaning variant.
ENGLISH_STOP = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its itself "
    "they them their theirs themselves what which who whom this that that'll these those "
    "am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such "
    "no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn "
    "hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Limits and sizes.
SEED = 1234
MAX_WORDS = 6000
LENGTH_BINS = 20
LEFT_EDGE_MARGIN = 0.001
THRESHOLD = 0.5
TARGET_PRECISION = 0.95
CJK_SHARE = 0.05
FIRST_NAME_YEAR = 1926
CONVERSATION_COLUMNS = ["conversation", "conversations", "dialogue", "dialog", "messages", "history"]
