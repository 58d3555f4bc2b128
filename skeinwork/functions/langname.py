"""Language names for two- and three-letter codes."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ISO 639-1 codes (with the withdrawn ones still in use) and
# their English names as the JDK prints them.
ISO_639_1 = """
aa Afar; ab Abkhazian; ae Avestan; af Afrikaans; ak Akan; am Amharic; an Aragonese; ar Arabic; as Assamese;
av Avaric; ay Aymara; az Azerbaijani; ba Bashkir; be Belarusian; bg Bulgarian; bh Bihari; bi Bislama;
bm Bambara; bn Bangla; bo Tibetan; br Breton; bs Bosnian; ca Catalan; ce Chechen; ch Chamorro; co Corsican;
cr Cree; cs Czech; cu Church Slavic; cv Chuvash; cy Welsh; da Danish; de German; dv Divehi; dz Dzongkha;
ee Ewe; el Greek; en English; eo Esperanto; es Spanish; et Estonian; eu Basque; fa Persian; ff Fulah;
fi Finnish; fj Fijian; fo Faroese; fr French; fy Western Frisian; ga Irish; gd Scottish Gaelic; gl Galician;
gn Guarani; gu Gujarati; gv Manx; ha Hausa; he Hebrew; hi Hindi; ho Hiri Motu; hr Croatian;
ht Haitian Creole; hu Hungarian; hy Armenian; hz Herero; ia Interlingua; id Indonesian; ie Interlingue;
ig Igbo; ii Sichuan Yi; ik Inupiaq; in Indonesian; io Ido; is Icelandic; it Italian; iu Inuktitut;
iw Hebrew; ja Japanese; ji Yiddish; jv Javanese; ka Georgian; kg Kongo; ki Kikuyu; kj Kuanyama; kk Kazakh;
kl Kalaallisut; km Khmer; kn Kannada; ko Korean; kr Kanuri; ks Kashmiri; ku Kurdish; kv Komi; kw Cornish;
ky Kyrgyz; la Latin; lb Luxembourgish; lg Ganda; li Limburgish; ln Lingala; lo Lao; lt Lithuanian;
lu Luba-Katanga; lv Latvian; mg Malagasy; mh Marshallese; mi Maori; mk Macedonian; ml Malayalam;
mn Mongolian; mo Moldavian; mr Marathi; ms Malay; mt Maltese; my Burmese; na Nauru; nb Norwegian Bokmål;
nd North Ndebele; ne Nepali; ng Ndonga; nl Dutch; nn Norwegian Nynorsk; no Norwegian; nr South Ndebele;
nv Navajo; ny Nyanja; oc Occitan; oj Ojibwa; om Oromo; or Odia; os Ossetic; pa Punjabi; pi Pali; pl Polish;
ps Pashto; pt Portuguese; qu Quechua; rm Romansh; rn Rundi; ro Romanian; ru Russian; rw Kinyarwanda;
sa Sanskrit; sc Sardinian; sd Sindhi; se Northern Sami; sg Sango; si Sinhala; sk Slovak; sl Slovenian;
sm Samoan; sn Shona; so Somali; sq Albanian; sr Serbian; ss Swati; st Southern Sotho; su Sundanese;
sv Swedish; sw Swahili; ta Tamil; te Telugu; tg Tajik; th Thai; ti Tigrinya; tk Turkmen; tl Tagalog;
tn Tswana; to Tongan; tr Turkish; ts Tsonga; tt Tatar; tw Twi; ty Tahitian; ug Uyghur; uk Ukrainian;
ur Urdu; uz Uzbek; ve Venda; vi Vietnamese; vo Volapük; wa Walloon; wo Wolof; xh Xhosa; yi Yiddish;
yo Yoruba; za Zhuang; zh Chinese; zu Zulu
"""


# Three-letter codes that page-count projects use. Their names come from the JDK.
THREE_LETTERS = """
ace als ang arc arz ast avk awa azb ban bar bcl bjn blk bpy bug bxr cbk cdo ceb cho chr chy ckb crh csb dag din diq dsb
dty eml ext fat frp frr fur gag gan gcr glk gom gor got gpe gsw guc gur guw hak haw hif hsb hyw ilo inh jam jbo kaa kab
kbd kbp kcg koi krc ksh lad lbe lez lfn lij lld lmo lrc ltg mad mai mdf mhr min mni mnw mrj mus mwl myv mzn nah nap nds
new nia nov nqo nrm nso olo pag pam pap pcd pcm pdc pfl pih pms pnb pnt pwn rmy rue sah sat scn sco shi shn skr smn srn
stq szl szy tay tcy tet tly tpi trv tum tyv udm vec vep vls war wuu xal xmf yue zea zgh
"""


def language_pairs() -> list[tuple[str, str]]:
    entries = (e.strip() for e in ISO_639_1.split(";"))
    return [tuple(e.split(" ", 1)) for e in entries if e]


@cache
def _named_by_jdk(jvm) -> list[tuple[str, str]]:
    locale = jvm.java.util.Locale
    names = [(code, locale.forLanguageTag(code).getDisplayLanguage(locale.ENGLISH)) for code in THREE_LETTERS.split()]
    return [(code, name) for code, name in names if name != code]


def language_table(spark: SparkSession) -> DataFrame:
    """Dimension table (code, name): a fixed table of some 300 rows."""
    return spark.createDataFrame(language_pairs() + _named_by_jdk(spark._jvm), "code string, name string")


def with_language_name(df: DataFrame, code: str, out: str = "lang_name") -> DataFrame:
    """Add the language name; an unknown code gives the code in lower case."""
    names = language_table(df.sparkSession).select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (
        df.join(F.broadcast(names), F.lower(F.col(code)) == F.col("_code"), "left")
        .withColumn(out, F.coalesce("_name", F.lower(F.col(code))))
        .drop("_code", "_name")
    )
