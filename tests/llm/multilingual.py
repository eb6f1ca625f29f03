"""Clean prose in Latin-script languages: the opening articles of the human rights declaration and plain sentences."""

CLEAN = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. "
    "Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista rotuun, väriin, sukupuoleen, kieleen, uskontoon, poliittiseen tai muuhun mielipiteeseen, "
    "kansalliseen tai yhteiskunnalliseen alkuperään, omaisuuteen, syntyperään tai muuhun tekijään perustuvaa erotusta. Kullakin yksilöllä on oikeus elämään, vapauteen ja henkilökohtaiseen turvallisuuteen. Ketään ei saa pitää orjana tai orjuutettuna.",
    "et": "Kõik inimesed sünnivad vabadena ja võrdsetena oma väärikuselt ja õigustelt. Neile on antud mõistus ja südametunnistus ja nende suhtumist üksteisesse peab kandma vendluse vaim. "
    "Igal inimesel peavad olema kõik käesoleva deklaratsiooniga välja kuulutatud õigused ja vabadused, olenemata rassist, nahavärvusest, soost, keelest, usulistest, poliitilistest või muudest veendumustest, "
    "rahvuslikust või sotsiaalsest päritolust, varanduslikust, seisuslikust või muust seisundist. Igal inimesel on õigus elule, vabadusele ja isikupuutumatusele.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek. "
    "Mindenki, bármely megkülönböztetésre, nevezetesen fajra, színre, nemre, nyelvre, vallásra, politikai vagy bármely más véleményre, nemzeti vagy társadalmi eredetre, vagyonra, születésre, vagy bármely más körülményre "
    "való tekintet nélkül hivatkozhat a jelen nyilatkozatban kinyilvánított összes jogokra és szabadságokra. Minden személynek joga van az élethez, a szabadsághoz és a személyi biztonsághoz.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. "
    "Herkes, ırk, renk, cinsiyet, dil, din, siyasi veya diğer herhangi bir akide, milli veya içtimai menşe, servet, doğuş veya herhangi diğer bir fark gözetilmeksizin "
    "işbu beyannamede ilan olunan tekmil haklardan ve bütün hürriyetlerden istifade edebilir. Yaşamak, hürriyet ve kişi emniyeti her ferdin hakkıdır. Hiç kimse kölelik veya kulluk altında bulundurulamaz.",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình bằng hữu. "
    "Ai cũng được hưởng những quyền tự do ghi trong bản tuyên ngôn này không phân biệt đối xử vì bất cứ lý do nào, như chủng tộc, màu da, nam nữ, ngôn ngữ, tôn giáo, chính kiến hay quan niệm.",
    "zu": "Bonke abantu bazalwa bekhululekile belingana ngesithunzi nangamalungelo. Bahlanganiswe wumcabango nangunembeza futhi kufanele baphathane ngomoya wobunye. "
    "Wonke umuntu unelungelo lokuphila, lenkululeko nelokuphepha. Akekho umuntu oyogcinwa ebugqilini noma ephoqwe ukuba abe yisigqila. Akekho umuntu oyohlushwa noma aphathwe ngendlela enonya. "
    "Umuntu wonke unelungelo lokwamukelwa njengomuntu phambi komthetho kuyo yonke indawo. Bonke abantu bayalingana phambi komthetho futhi banelungelo lokuvikelwa ngokulinganayo. Ngizobona abangani bami ekhaya kusasa ekuseni ngoba sizosebenza ndawonye ensimini.",
}
