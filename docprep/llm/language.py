"""Languages of texts by models of their character trigrams, fitted on labelled texts, in numpy over a whole batch."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docprep.llm.sketch import character_codes, grams

#: Most labelled texts of a language that are fitted on, taken in the order of a hash, and the longest in code points.
MOST_TEXTS, LONGEST_TEXT = 200, 20_000
_BITS = 15
_SIZE = 1 << _BITS
_CHUNK = 1_000_000
#: Trigrams from which on a language is well known.
AMPLE = 10_000
_NO_LETTER = re.compile(r"(?:[^\w\n]|[\d_])+")
#: The first article of the Universal Declaration of Human Rights, as a first text of each language.
FIRST_TEXTS = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
    "sv": "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete och bör handla gentemot varandra i en anda av broderskap.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "ms": "Semua manusia dilahirkan bebas dan samarata dari segi kemuliaan dan hak-hak. Mereka mempunyai pemikiran dan perasaan hati dan hendaklah bertindak di antara satu sama lain dengan semangat persaudaraan.",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
}
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is for with on at by from be should who which what when how if that are as after or an may has not it this was were than does a there about more",
    "fr": "le la les des du de et un une est sont pour avec dans sur par au aux en que qui ne pas plus après chez être doit faut mois jours quelle quand ou cas il elle on se si tous toutes convient lorsque semaines",
    "de": "der die das den dem des und ein eine einen ist sind für mit auf bei nach von zu im am darf nicht wird werden soll wann welche wie lang oder als unter alle",
    "es": "el la los las de del y un una es son para con en por que no más después se debe cuando qué cuándo tras al meses días si como su sobre o hace",
    "it": "il lo la gli le di del della e un una è sono per con in da che non più dopo si deve quando quale al mesi giorni se come o nei dei",
    "pt": "o a os as do da de e um uma é são para com em por que não mais depois se deve quando qual ao meses dias como ou nos dos",
    "nl": "de het een van en is zijn voor met op bij na door te in niet meer dan moet wanneer welke hoe dagen maanden of als aan",
    "ms": "yang dan di ke dari untuk dengan pada ini itu adalah perlu tidak bagi atau jika selepas hari bulan pesakit setiap boleh oleh dalam bilakah berapakah sehari lebih hendaklah",
    "sv": "och att det som en ett på är av för med inte till den om så kan ska bör från vid eller har när vad hur minst dagar veckor månader efter",
    "da": "og at det som en et på er af for med ikke til den om så kan skal bør fra ved eller har når hvad hvor mindst dage uger måneder efter",
    "fi": "ja on ei se että hän oli olla kun mutta niin kuin tai jos vain myös mitä miten pitää voi päivää viikkoa kuukautta jälkeen",
    "pl": "i w na nie się do to że jest z co jak po dla przez od czy być może oraz lub jeśli należy dni tygodni miesięcy pacjent",
    "cs": "a v na se je že to s z do o ne jako pro by být nebo pokud po při dnů týdnů měsíců pacient",
    "ro": "și în de la cu nu este pe care pentru din mai sau dacă după trebuie zile săptămâni luni pacient",
    "tr": "ve bir bu için ile da de ne olarak daha çok gibi kadar sonra veya eğer gün hafta ay hasta olmalıdır",
    "vi": "và của là có không được cho với trong một các người này khi từ sau nếu hoặc ngày tuần tháng bệnh nhân",
    "zh": "的 一 是 不 了 在 有 和 人 这 中 为 上 个 到 应 者 时 或 与 日 每 后 病 何",
}


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of each trigram of letters; whatever isn't a letter is a space."""
    owner, h = grams(character_codes(texts, _NO_LETTER), 3)
    return owner, (h >> np.uint64(64 - _BITS)).astype(np.int64)


@dataclass
class Languages:
    """names, the logarithm of each trigram bucket's probability by language and the trigrams it was fitted on.

    The last row of the table is any other language's.
    """

    names: list[str]
    table: np.ndarray
    seen: np.ndarray

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """([texts, languages + 1] log likelihoods, trigrams) of each text, over a megabyte of text at a time."""
        out, count = np.zeros((len(texts), len(self.table))), np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop] or "") < _CHUNK):
                size += len(texts[stop] or "")
                stop += 1
            owner, bucket = _trigrams(texts[at:stop])
            first = np.searchsorted(owner, np.arange(stop - at))
            count[at:stop] = n = np.diff(np.append(first, len(owner)))
            for k, row in enumerate(self.table):
                sums = np.concatenate((row[bucket], np.zeros(1, np.float32)))
                out[at:stop, k] = np.where(n > 0, np.add.reduceat(sums, first), 0)
            at = stop
        return out, count

    def name(self, text: str | None, margin: float = 6.0) -> str | None:
        """The language of a text, 'other' included, where it leads the next one by the margin; else None."""
        s, n = self.scores([text])
        first, second = np.argsort(s[0])[::-1][:2]
        return None if s[0][first] - s[0][second] < margin else [*self.names, "other"][first]

    def differ(self, asked: list[str | None], given: list[str | None], least: int = 8, margin: float = 10.0, each: float = 0.35, other: float = 0.8) -> np.ndarray:
        """Whether each answer is in another language than its question.

        The question's language must lead; in it the answer must be less likely than in another one by the margin, and
        by so much for each trigram: by `each` if that is a known language, by `other` if it is none of them.
        """
        q, _ = self.scores(asked)
        a, n = self.scores(given)
        at = np.arange(len(asked))
        best = q[:, :-1].argmax(axis=1)
        rest = q.copy()
        rest[at, best] = -np.inf
        leads = q[at, best] - rest.max(axis=1) >= 6.0
        own = a[at, best]
        scale = np.where(self.seen[best] < AMPLE, 2, 1)
        known = (a[:, :-1].max(axis=1) - own) / scale
        unknown = (a[:, -1] - own) / scale
        return leads & (n >= least) & ((known >= np.maximum(margin, each * n)) | (unknown >= np.maximum(2 * margin, other * n)))


def fit(texts: list[str], names: list[str]) -> Languages:
    """Models of the labelled texts, each language's function words and first text among them; smoothed toward all buckets."""
    every = [*FIRST_TEXTS.items(), *FUNCTION_WORDS.items(), *zip(names, texts)]
    known = sorted({n for n, _ in every})
    owner, bucket = _trigrams([t for _, t in every])
    language = np.array([known.index(n) for n, _ in every])[owner]
    count = np.bincount(language * _SIZE + bucket, minlength=len(known) * _SIZE).reshape(len(known), _SIZE).astype(np.float64)
    smooth = 0.05
    table = np.log((count + smooth) / (count.sum(axis=1, keepdims=True) + smooth * _SIZE))
    return Languages(known, np.vstack([table, np.full(_SIZE, -np.log(_SIZE))]).astype(np.float32), count.sum(axis=1))


def labelled_texts(documents: DataFrame, id: str, text: str, lang: str, most: int = MOST_TEXTS, longest: int = LONGEST_TEXT) -> tuple[list[str], list[str]]:
    """(texts, languages): at most so many texts of each language of two letters, in the order of their ids' hashes; a bounded sample to fit on.

    Null ids, other labels and texts that are too short or too long are left out; a repeated id counts once.
    """
    code = F.lower(F.regexp_extract(F.trim(F.col(lang)), r"^([A-Za-z]{2})(?:[-_].*)?$", 1))
    named = documents.select(F.col(id).alias("i"), F.col(text).cast("string").alias("t"), code.alias("c")).where((F.length("c") == 2) & F.length("t").between(20, longest))
    # Spark keeps the first rows of each group before the shuffle, so a common language is no hot group
    by_hash = Window.partitionBy("c").orderBy("h", "i")
    chosen = named.select("c", "i", F.xxhash64("i").alias("h")).distinct().withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= most).select("c", "i", "h")
    rows = named.join(F.broadcast(chosen), ["c", "i"]).dropDuplicates(["c", "i"]).orderBy("c", "h", "i").collect()  # at most `most` of each of 26 * 26 codes
    return [r.t for r in rows], [r.c for r in rows]
