"""The stopword list: Dutch, English and Spanish, and a few custom words."""

from __future__ import annotations

import functools

# The usual Dutch stopwords.
DUTCH = """
de en van ik te dat die in een hij het niet zijn is was op aan met als voor had er maar om hem dan zou of wat
mijn men dit zo door over ze zich bij ook tot je mij uit der daar haar naar heb hoe heeft hebben deze u want
nog zal me zij nu ge geen omdat iets worden toch al waren veel meer doen toen moet ben zonder kan hun dus
alles onder ja eens hier wie werd altijd doch wordt wezen kunnen ons zelf tegen na reeds wil kon niets uw
iemand geweest andere
"""

# The usual English stopwords, with the stems that a stripped apostrophe leaves.
ENGLISH = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't here's how's let's that's there's what's when's where's who's why's ain aren couldn
didn doesn hadn hasn haven isn mightn mustn needn shan shouldn wasn weren wouldn
"""

# The usual Spanish stopwords.
SPANISH = """
de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque
esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni
contra otros ese eso ante ellos e esto mí antes algunos qué unos yo otro otras otra él tanto esa estos mucho
quienes nada muchos cual poco ella estar estas algunas algo nosotros mi mis tú te ti tu tus ellas nosotras
vosostros vosostras os mío mía míos mías tuyo tuya tuyos tuyas suyo suya suyos suyas nuestro nuestra nuestros
nuestras vuestro vuestra vuestros vuestras esos esas estoy estás está estamos estáis están esté estés estemos
estéis estén estaré estarás estará estaremos estaréis estarán estaría estarías estaríamos estaríais estarían
estaba estabas estábamos estabais estaban estuve estuviste estuvo estuvimos estuvisteis estuvieron estuviera
estuvieras estuviéramos estuvierais estuvieran estuviese estuvieses estuviésemos estuvieseis estuviesen
estando estado estada estados estadas estad he has ha hemos habéis han haya hayas hayamos hayáis hayan habré
habrás habrá habremos habréis habrán habría habrías habríamos habríais habrían había habías habíamos habíais
habían hube hubiste hubo hubimos hubisteis hubieron hubiera hubieras hubiéramos hubierais hubieran hubiese
hubieses hubiésemos hubieseis hubiesen habiendo habido habida habidos habidas soy eres es somos sois son sea
seas seamos seáis sean seré serás será seremos seréis serán sería serías seríamos seríais serían era eras
éramos erais eran fui fuiste fue fuimos fuisteis fueron fuera fueras fuéramos fuerais fueran fuese fueses
fuésemos fueseis fuesen sintiendo sentido sentida sentidos sentidas siente sentid tengo tienes tiene tenemos
tenéis tienen tenga tengas tengamos tengáis tengan tendré tendrás tendrá tendremos tendréis tendrán tendría
tendrías tendríamos tendríais tendrían tenía tenías teníamos teníais tenían tuve tuviste tuvo tuvimos
tuvisteis tuvieron tuviera tuvieras tuviéramos tuvierais tuvieran tuviese tuvieses tuviésemos tuvieseis
tuviesen teniendo tenido tenida tenidos tenidas tened
"""

# Custom words.
CUSTOM = "echt haha gaan gaat even"


@functools.lru_cache(maxsize=1)
def stopwords() -> tuple[str, ...]:
    """All words, sorted."""
    return tuple(sorted(set(" ".join((DUTCH, ENGLISH, SPANISH, CUSTOM)).split())))
