"""Parameters of the registered queries (shared by the Spark plans and the
oracle SQL so both sides ask the same question)."""

# change window [lo, hi) on `modified`, per source table
FILM_LO, FILM_HI = "1998-01-01 00:00:00", "1998-07-01 00:00:00"
PERSON_LO, PERSON_HI = "2001-01-01 00:00:00", "2002-01-01 00:00:00"
GENRE_LO, GENRE_HI = "2001-06-01 00:00:00", "2002-01-01 00:00:00"

# catalogue page
PAGE = 3

# admin search terms
FILM_SEARCH = "urgent 7"
PERSON_SEARCH = "supplier 00"
GENRE_SEARCH = "red"

# admin filters
FILTER_TYPE = "F"
FILTER_GENRE_NAME = "blue bolt"

# constraint limits on the test mapping (titles are priorities, ratings prices,
# types order states)
RATING_RANGE = (0.0, 400000.0)
FILM_TYPES = ("F", "O")
GENRE_NAME_MAX = 9

# strict body keys for the events feed
EVENT_KEYS = ("k",)
DETAIL_ID = 7              # a film of every scale
BUCKETS = 4                # rows at most per document of the bucketed index

# a micro-batch of changes (source, id): films of one day, one person, two genres
BATCH_DAY, BATCH_NEXT_DAY = "1998-03-02 00:00:00", "1998-03-03 00:00:00"
BATCH_PERSONS, BATCH_GENRES = (3,), (7, 70)

# nested and flat name conditions
NESTED_GROUP, NESTED_TEXT, NESTED_ID = "actors", "supplier", 7
NAMES_GROUP, NAMES_TEXT = "genres", "Blue bolt"

# pages of the change feed by the index of ranges: the first, one in the middle, the last
FEED_SIZE, FEED_RANGES = 100, 16
# contains searches by trigrams: (query name, table, term text)
GRAM_SEARCHES = ("urgent 7", "LOW 1", "high zzz", "9", "4-not 00")

# films, persons and genres that are removed from the tables behind the indexes
REMOVED_FILMS, REMOVED_PERSONS, REMOVED_GENRES = (1, 7, 32, 130), (3,), (7, 70)

# values that the rejects query takes away
LOST_TITLE, LOST_TYPE = "5-LOW", "P"
