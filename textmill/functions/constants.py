"""Fixed values that must equal the reference's for right results."""

# --- fixed values (special tokens; id = position in this list) ---------------
PAD, UNK, CLS, SEP, MSK = "<pad>", "<unk>", "<cls>", "<sep>", "<msk>"
SPECIAL_TOKENS = [PAD, UNK, CLS, SEP, MSK]
PAD_ID, UNK_ID, CLS_ID, SEP_ID, MSK_ID = 0, 1, 2, 3, 4
N_SPECIAL = 5
WORD_END = "_"
# word-start mark of vocabulary files with unigram scores
WORD_START = "▁"
# masked-token rates: share of positions, then MSK / unchanged shares of those
MASK_RATE, MSK_SHARE, SAME_SHARE = 0.15, 0.8, 0.1
# positive label text of the labelled CSV
POSITIVE_LABEL = "positive"
# pre-training epoch sizes: steps x batch size
TRAIN_STEPS, VAL_STEPS, BATCH_SIZE = 2000, 200, 16
# positional table: rows, width, wavelength base
POS_MAX_LEN, POS_DIM, POS_BASE = 1000, 256, 10000.0
# segment table rows; PCA components kept in the vector analysis
MAX_SEGMENTS, PCA_K = 3, 7
# ------------------------------------------------------------------------------

# Word splitting of raw text (our own choice for the driver tables).
WORD_SPLIT_REGEX = "[ \n\t]+"

# A small hand-picked list of multi-character pieces used as the fixed part of
# the demonstration vocabulary for the SQL-checked encode queries. The rest of
# that vocabulary is the alphabet of the corpus, so every text is covered.
DEMO_PIECES = [
    "the_", "and_", "der_", "die_", "und_", "les_", "des_", "que_", "los_",
    "ing", "tion", "ment", "eau", "sch", "ein", "ent", "ion", "ich", "ung",
    "er", "en", "es", "on", "an", "in", "re", "th", "ch", "ou", "de", "le",
    "la", "el", "ie", "ei", "te", "st", "nd", "e_", "s_", "n_", "r_", "t_",
]

# Stride used to spread the random replacement ids of one example (a prime).
RANDOM_ID_STRIDE = 1000003
