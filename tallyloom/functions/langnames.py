"""English names of language codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ISO 639-1 codes and their English names, with the older codes
# iw, in and ji that feeds still send.
LANGUAGE_NAMES = """
aa Afar
ab Abkhazian
ae Avestan
af Afrikaans
ak Akan
am Amharic
an Aragonese
ar Arabic
as Assamese
av Avaric
ay Aymara
az Azerbaijani
ba Bashkir
be Belarusian
bg Bulgarian
bh Bihari
bi Bislama
bm Bambara
bn Bengali
bo Tibetan
br Breton
bs Bosnian
ca Catalan
ce Chechen
ch Chamorro
co Corsican
cr Cree
cs Czech
cu Church Slavic
cv Chuvash
cy Welsh
da Danish
de German
dv Divehi
dz Dzongkha
ee Ewe
el Greek
en English
eo Esperanto
es Spanish
et Estonian
eu Basque
fa Persian
ff Fulah
fi Finnish
fj Fijian
fo Faroese
fr French
fy Frisian
ga Irish
gd Scottish Gaelic
gl Gallegan
gn Guarani
gu Gujarati
gv Manx
ha Hausa
he Hebrew
hi Hindi
ho Hiri Motu
hr Croatian
ht Haitian
hu Hungarian
hy Armenian
hz Herero
ia Interlingua
id Indonesian
ie Interlingue
ig Igbo
ii Sichuan Yi
ik Inupiaq
in Indonesian
io Ido
is Icelandic
it Italian
iu Inuktitut
iw Hebrew
ja Japanese
ji Yiddish
jv Javanese
ka Georgian
kg Kongo
ki Kikuyu
kj Kwanyama
kk Kazakh
kl Greenlandic
km Khmer
kn Kannada
ko Korean
kr Kanuri
ks Kashmiri
ku Kurdish
kv Komi
kw Cornish
ky Kirghiz
la Latin
lb Luxembourgish
lg Ganda
li Limburgish
ln Lingala
lo Lao
lt Lithuanian
lu Luba-Katanga
lv Latvian
mg Malagasy
mh Marshallese
mi Maori
mk Macedonian
ml Malayalam
mn Mongolian
mr Marathi
ms Malay
mt Maltese
my Burmese
na Nauru
nb Norwegian Bokmål
nd North Ndebele
ne Nepali
ng Ndonga
nl Dutch
nn Norwegian Nynorsk
no Norwegian
nr South Ndebele
nv Navajo
ny Nyanja
oc Occitan
oj Ojibwa
om Oromo
or Oriya
os Ossetian
pa Panjabi
pi Pali
pl Polish
ps Pushto
pt Portuguese
qu Quechua
rm Raeto-Romance
rn Rundi
ro Romanian
ru Russian
rw Kinyarwanda
sa Sanskrit
sc Sardinian
sd Sindhi
se Northern Sami
sg Sango
si Sinhalese
sk Slovak
sl Slovenian
sm Samoan
sn Shona
so Somali
sq Albanian
sr Serbian
ss Swati
st Southern Sotho
su Sundanese
sv Swedish
sw Swahili
ta Tamil
te Telugu
tg Tajik
th Thai
ti Tigrinya
tk Turkmen
tl Tagalog
tn Tswana
to Tonga
tr Turkish
ts Tsonga
tt Tatar
tw Twi
ty Tahitian
ug Uighur
uk Ukrainian
ur Urdu
uz Uzbek
ve Venda
vi Vietnamese
vo Volapük
wa Walloon
wo Wolof
xh Xhosa
yi Yiddish
yo Yoruba
za Zhuang
zh Chinese
zu Zulu
"""


def language_names(spark: SparkSession) -> DataFrame:
    """``lang_code, language``: a fixed table of fewer than 200 rows."""
    rows = [tuple(line.split(" ", 1)) for line in LANGUAGE_NAMES.split("\n") if line]
    return spark.createDataFrame(rows, "lang_code string, language string")


def with_language_name(df: DataFrame, code: str, name: str = "language") -> DataFrame:
    """Add the English name of ``code``; an unknown code names itself.

    The broadcast side is the fixed table above, so its size never grows.
    """
    names = language_names(df.sparkSession).select(
        F.col("lang_code").alias("_code"), F.col("language").alias("_name")
    )
    return (
        df.join(F.broadcast(names), F.col(code) == F.col("_code"), "left")
        .withColumn(name, F.coalesce("_name", code))
        .drop("_code", "_name")
    )
