"""Wording of error pages, script notices and filler in ten languages, as templates.

A template stands for all strings its groups spell out: "(a|b) c" is "a c" and "b c", and "(a |)b" is "a b" and "b".
Of each kind there are phrases that say what is wrong by themselves (ERROR, SCRIPT, FILLER), and RELATED ones that stand
around them, such as advice or what the visitor was looking for; these never make a field residue alone. The templates
follow the reason phrases of HTTP and the usual wording of servers, content systems and delivery networks, not that of
any one site. Words that state a failed capture (expired certificate, refused connection, timeout of a host) are left
out: they are a diagnosis.
"""

from __future__ import annotations

import re
from itertools import product

_GROUP = re.compile(r"\(([^()]*)\)")


def spelled(template: str) -> list[str]:
    """All strings of a template."""
    parts = _GROUP.split(template)  # literals at even places, groups at odd ones
    choices = [[p] if i % 2 == 0 else p.split("|") for i, p in enumerate(parts)]
    return sorted({" ".join("".join(c).split()) for c in product(*choices)} - {""})


ERROR = [
    # HTTP
    "bad request", "unauthorized", "forbidden", "method not allowed", "not acceptable", "proxy authentication required", "request (timeout|time-out|timed out)", "length required", "precondition failed",
    "(payload|content|request entity) too large", "(uri|request-uri) too long", "unsupported media type", "too many requests", "internal (server |)error", "not implemented", "bad gateway",
    "service( temporarily| is|) unavailable", "http status", "(backend|connection|fetch|request) failed", "(gateway|connection) (timeout|time-out|timed out)", "http version not supported", "404 not found",
    # en
    "(page|file|document|url|resource|article|content|site|link|address|story|post|object|item|object) (not found|could not be found|cannot be found|can't be found|couldn't be found|does not exist|doesn't exist|no longer exists|is no longer available|is not available|isn't available|is unavailable|is temporarily unavailable|has been removed|may have been removed|has been deleted|has expired|was not found|is under construction)",
    "(page|document|url) you (are looking for|were looking for|requested) (could not be found|cannot be found|can't be found|does not exist|doesn't exist|no longer exists|is not available|is no longer available|has been removed|was not found)",
    "(can't|cannot|couldn't|could not) (find|locate|open|load|display) (that|this|the) (page|file|document|site)", "this (page|site) (can't|cannot) be (reached|displayed)", "this (page|site) isn't (working|available)",
    "(access|request|permission) (denied|blocked|rejected|to this page has been denied)", "you (do not|don't) have permission( to access| to view|)", "you have been blocked", "(down for|under|undergoing|unavailable for) (scheduled |routine |planned |)maintenance", "(site|page|website|section) (is |)under construction", "(security check|security verification)( to access| required|)", "(encountered|experienced) an (unexpected |internal |)error", "(could not|couldn't|cannot) be retrieved",
    "(something|oops, something) went wrong", "an (unexpected |unknown |internal |)error( has|) occurred", "(application|fatal|database|server|system) error", "error establishing a database connection", "(your |)session( has|) expired",
    "(verify|verifying|confirm|prove|show|checking|check) (that |if |)you are( a|) human", "(verify|confirm|prove) (that |)you (are|are) not a (robot|bot)", "are you a (robot|human)", "(complete|solve) the captcha", "unusual traffic( was detected|) from your( computer|) network",
    "checking your browser( before accessing|)", "completing the action below", "(log|sign) in again to continue", "unable to (load|display|connect|process|complete)( the page| this page| to the server| to the site| your request|)", "attention required", "just a moment", "not found on this server",
    "(payment|upgrade|precondition) required", "misdirected request", "unprocessable (content|entity)", "failed dependency", "request header fields too large", "unavailable for legal reasons", "insufficient storage", "loop detected", "network authentication required", "range not satisfiable", "expectation failed", "(410 gone|409 conflict|423 locked|418 i'm a teapot)",
    "no such file( or directory|)", "invalid (request|url|hostname|link)", "(temporarily |currently |)unable to service your request", "(maintenance downtime|capacity problems)", "(video|page|content|site|website|item|service|post|account) (is |)(unavailable|not available)( in your country| in your region| right now|)", "(file|page|document) you requested was not found",
    "(your|this) (ip|ip address|account|device) (has been|is|was) (blocked|banned|suspended)", "too many (login |failed |)attempts", "(loading|please wait)(, please wait| while we load|...)", "(error|failed) (loading|to load) (the |this |)(page|content|resource|video)",
    # pt
    "(erro|falha) ao (carregar|abrir|exibir|acessar) (a|o|esta|este) (página|conteúdo|site|arquivo|vídeo)", "(página|site|seção) em construção", "(o |)site está( temporariamente|) (fora do ar|indisponível|em manutenção)", "acesso (restrito|limitado)", "conteúdo (exclusivo para assinantes|restrito|bloqueado|indisponível)",
    "(página|pagina|arquivo|documento|conteúdo|endereço|url|link|matéria|notícia|artigo|recurso) (não encontrada|não encontrado|nao encontrada|nao encontrado|não localizada|não localizado|não disponível|indisponível|inexistente|não existe|não existe mais|foi removida|foi removido|não está mais disponível)",
    "não (achamos|encontramos|localizamos|conseguimos encontrar|conseguimos localizar|foi possível encontrar|foi possível carregar|foi possível exibir|foi possível abrir) (a|o|esta|este|essa|esse) (página|arquivo|conteúdo|endereço)",
    "(a página|o conteúdo|o endereço|o link|o arquivo) (que você procura|que você procurava|que você buscou|digitado|solicitado|solicitada) (saiu do ar|não existe|não existe mais|não foi encontrado|não foi encontrada|mudou de lugar|foi removido|foi removida|não existe ou mudou de lugar|não existe ou foi removida)",
    "acesso (negado|bloqueado|proibido|não autorizado)", "(falha interna|erro interno) (do|no) (servidor|sistema)", "erro interno", "serviço( temporariamente|) indisponível", "(estamos|site|portal|página|sistema) em manutenção", "(sua |)sessão (expirada|expirou|encerrada)",
    "(seu|o seu|o) (pedido|acesso) foi (recusado|bloqueado|negado)", "requisição (inválida|recusada|bloqueada)", "(muitas|excesso de) (requisições|solicitações|tentativas)", "tráfego (incomum|suspeito|anormal)( na sua rede| em sua rede| da sua rede|)",
    "(prove|confirme|comprove|verifique) que( você|) não é um robô", "(prove|confirme|verifique) (que|se) você é( um|) humano", "não sou um robô", "(algo deu|alguma coisa deu) errado", "(ocorreu|houve) um erro( inesperado|)", "(site|página) fora do ar",
    # es
    "(página|pagina|archivo|documento|contenido|artículo|dirección|enlace|recurso) (no encontrada|no encontrado|no disponible|no existe|inexistente|no se encuentra|ya no existe|ya no está disponible|ha sido eliminada|ha sido eliminado)",
    "no (pudimos|hemos podido|se pudo|podemos|se puede) (hallar|encontrar|cargar|mostrar|abrir) (la|el|esta|este) (página|contenido|archivo|sitio)", "(la página|el contenido|el enlace) que (busca|buscas|está buscando|estás buscando|ha solicitado) (no existe|ya no existe|no está disponible|ha sido eliminado|no se encuentra)",
    "acceso (denegado|bloqueado|prohibido|no autorizado)", "error interno( del servidor|)", "servicio (no disponible|temporalmente no disponible)", "(estamos|sitio|página) en mantenimiento", "(su |tu |la |)sesión ha (expirado|caducado)", "sesión (expirada|caducada)", "demasiadas (solicitudes|peticiones)", "solicitud (incorrecta|bloqueada|rechazada)",
    "tráfico inusual( en su red| desde su red|)", "(confirme|confirma|verifique|verifica|demuestre) que( usted|) (no es un robot|no eres un robot|es humano|eres humano)", "no soy un robot", "algo salió mal", "(ha ocurrido|se ha producido|ocurrió) un error( inesperado|)", "la dirección no existe( o cambió de lugar|)",
    "(la página|el contenido|el archivo|el recurso) (solicitada|solicitado) (no existe|no se encuentra|no está disponible)", "error al (cargar|abrir|mostrar) (la|el) (página|contenido|archivo|sitio)", "(página|sitio) en construcción", "acceso (restringido|limitado)",
    # fr
    "(le service|le site|la page|ce contenu) est( momentanément| temporairement| actuellement|) indisponible", "erreur (lors du|de) chargement( de la page|)", "accès (restreint|limité)",
    "(page|fichier|document|contenu|article|ressource|adresse) (introuvable|non trouvée|non trouvé|inexistante|inexistant|indisponible|n'existe pas|n'existe plus)", "(la page|le document|le contenu|l'article|l'adresse) (que vous cherchez|que vous recherchez|demandée|demandé|n'existe pas) (n'existe pas|n'existe plus|est introuvable|ou a changé|a été supprimée|a été supprimé|n'a pas été trouvée)",
    "accès (bloqué|refusé|interdit|non autorisé)", "erreur interne( du serveur|)", "service( temporairement|) indisponible", "(site|page) en (maintenance|construction)", "(en cours de|en) maintenance", "(votre |)session (a expiré|expirée)", "trop de requêtes", "requête (incorrecte|bloquée|refusée)", "trafic inhabituel( provenant de votre réseau|)",
    "(vérifiez|confirmez|prouvez) que vous (êtes humain|êtes un humain|n'êtes pas un robot)", "je ne suis pas un robot", "(quelque chose|un problème) s'est (mal passé|produit)", "une erreur (inattendue |)(est survenue|s'est produite)", "l'adresse n'existe pas( ou a changé|)", "nous ne trouvons pas( cette|) page",
    # de, it, nl
    "(diese|die) (website|webseite|seite) ist( derzeit| momentan| zurzeit|) nicht (erreichbar|verfügbar)", "zugriff nicht (erlaubt|gestattet|möglich)", "(seite|website) im aufbau", "fehler beim laden( der seite|)", "errore (durante il|nel) caricamento( della pagina|)", "(pagina|sito) in costruzione", "accesso (limitato|riservato)", "fout bij het laden( van de pagina|)", "toegang niet toegestaan",
    "(seite|datei|dokument|inhalt|artikel|adresse)( wurde| konnte|) nicht (gefunden|gefunden werden|verfügbar|vorhanden)", "(diese|die|gesuchte|angeforderte|aufgerufene) seite (existiert nicht|existiert nicht mehr|ist nicht verfügbar|ist nicht erreichbar|konnte nicht gefunden werden|wurde nicht gefunden)",
    "zugriff (verweigert|gesperrt)", "(interner|ein interner) serverfehler", "(dienst|seite|server)( vorübergehend| derzeit| momentan|) nicht (verfügbar|erreichbar)", "vorübergehend nicht erreichbar", "(wegen wartungsarbeiten|wartungsarbeiten|wartungsmodus)", "(ihre |)sitzung ist abgelaufen", "zu viele anfragen", "(bestätigen|beweisen) sie, dass sie (ein mensch|kein roboter) sind", "ich bin kein roboter", "etwas ist schiefgelaufen", "ein( unerwarteter|) fehler ist aufgetreten",
    "(pagina|file|documento|contenuto|risorsa|articolo) non (trovata|trovato|disponibile|esiste|esiste più)", "(la pagina|il contenuto) (che cerchi|che stai cercando|richiesta|richiesto) non (esiste|esiste più|è disponibile|è stata trovata|è stato trovato)", "accesso (negato|bloccato|vietato)", "errore interno( del server|)", "servizio( temporaneamente| momentaneamente|) non disponibile", "(sito|pagina) in manutenzione", "sessione scaduta", "troppe richieste",
    "(conferma|verifica|dimostra) (che sei|di essere) (umano|un essere umano)", "(conferma|verifica|dimostra) di non essere un robot", "non sono un robot", "qualcosa è andato storto", "si è verificato un errore( imprevisto|)",
    "(pagina|bestand|document|artikel) niet (gevonden|beschikbaar)", "(de|deze) pagina (bestaat niet|bestaat niet meer|is niet beschikbaar|kan niet worden gevonden|kon niet worden gevonden|die u zoekt bestaat niet)", "toegang (geweigerd|geblokkeerd)", "interne serverfout", "dienst niet beschikbaar", "(wegens onderhoud|in onderhoud)", "(uw |je |)sessie is verlopen", "te veel (verzoeken|aanvragen)", "ik ben geen robot", "(bevestig|controleer) dat (u|je) (een mens|geen robot) (bent|ben)", "er (ging|is) iets (mis|misgegaan|fout gegaan)", "er is een( onverwachte|) fout opgetreden",
    # pl, ru, tr
    "błąd (ładowania|wczytywania) strony", "strona w budowie", "(такой|этой|запрашиваемой) страницы (не существует|нет)", "ошибка загрузки( страницы|)", "сайт на реконструкции", "sayfa yüklenemedi", "yapım aşamasında",
    "(nie znaleziono|nie można znaleźć) (strony|pliku|dokumentu)", "strona( nie została|) nie (istnieje|została znaleziona)", "strona nie istnieje", "(brak|odmowa) dostępu", "dostęp zabroniony", "wewnętrzny błąd serwera", "usługa( tymczasowo|) niedostępna", "(przerwa techniczna|prace konserwacyjne)", "sesja wygasła", "zbyt wiele żądań", "(potwierdź|sprawdź), że (jesteś człowiekiem|nie jesteś robotem)", "nie jestem robotem", "coś poszło nie tak", "wystąpił( nieoczekiwany|) błąd",
    "(страница|файл|документ) не (найдена|найден|существует)", "доступ (запрещен|запрещён|закрыт|ограничен)", "(внутренняя ошибка|ошибка) сервера", "(сервис|сайт|сервер)( временно|) недоступен", "(технические работы|ведутся технические работы)", "сессия истекла", "слишком много запросов", "(подтвердите|докажите), что вы (не робот|человек)", "я не робот", "что-то пошло не так", "произошла( непредвиденная|) ошибка",
    "(sayfa|dosya|içerik) (bulunamadı|mevcut değil)", "erişim (engellendi|reddedildi|yasak)", "(iç|dahili) sunucu hatası", "(hizmet|servis)( geçici olarak|) (kullanılamıyor|kullanım dışı)", "(bakım çalışması|bakımdayız)", "oturumunuz sona erdi", "çok fazla istek", "robot (olmadığınızı|değilim)( doğrulayın|)", "bir (şeyler ters gitti|hata oluştu)",
]

SCRIPT = [
    "javascript", "(suporte a|sem suporte a) (script|scripts|javascript)", "(scripts|script) (are disabled|is disabled|blocked|desligados|desativados|bloqueados|permitidos|desactivados|désactivés)", "(os scripts|seus scripts|los scripts|the scripts|les scripts)",
    "(verificando|verificar) o seu navegador", "noscript",
]

FILLER = [
    "(insert|add|enter|type|put|write) (your |body |the |some |)(copy|text|content|headline|title|caption)( here|)", "(your|sample|placeholder|dummy|example|test) (text|content|headline|title|caption|paragraph|page|post)( here| goes here|)", "(test|sample|example|demo) (post|page|article|entry)( please ignore|)", "(headline|title|text|content|copy|caption) goes here", "hello world", "untitled( document| page|)", "just another wordpress site", "coming soon",
    "(texto|título|conteúdo|manchete|parágrafo|legenda|matéria|corpo) (provisório|provisória|de exemplo|de teste|de preenchimento|modelo|aqui)", "(escreva|insira|digite|coloque|adicione) (o |)(seu |)(texto|título|conteúdo)( aqui|)", "título da página( aqui|)", "aqui (vai|vem|entra) (o|a) (corpo|texto|título|manchete|conteúdo)( da matéria| da notícia| do texto|)", "[texto provisório]", "(substituir|trocar|remover) antes de publicar", "sem título",
    "texto de (relleno|ejemplo|prueba|muestra)", "(escriba|escribe|inserte|inserta|ingrese) (aquí |)(su|tu|el) (texto|título|contenido)( aquí|)", "(título|texto) (de ejemplo|aquí)", "votre (texte|titre|contenu)( ici|)", "(insérez|saisissez|ajoutez|écrivez) (votre|le|un) (texte|titre|contenu)( ici|)", "texte (d'exemple|de remplacement|provisoire|factice|ici)", "faux texte",
    "(blindtext|beispieltext|platzhaltertext|platzhalter)", "(hier|ihr) (steht ihr text|text hier|text)", "testo (segnaposto|di esempio|di prova|qui)", "(inserisci|scrivi) (il tuo |qui il |)testo( qui|)", "(voorbeeldtekst|plaatshouder)", "(uw|je) tekst hier", "(przykładowy tekst|tekst zastępczy|wpisz tekst)", "(пример текста|введите текст|текст-заполнитель|ваш текст)", "(örnek metin|metninizi buraya yazın)",
    "test", "teste", "tk", "tktk", "tbd", "asdf", "asdfasdf", "blá", "blah", "bla", "qwerty", "xxx", "xxxx", "xxxxx", "xxxxxx", "foo", "bar", "foobar",
]

RELATED = [
    # en
    "oops", "(whoops|sorry|we're sorry|we are sorry)", "(the|this|that|our) (page|site|website|link|url|server|document|address|app|reader|origin|web server|browser)", "(the |)(requested|original) (page|url|resource|address|content)", "you (are|were) (looking for|trying to reach|trying to access)", "you (requested|tried to access|tried to reach)", "(does not|doesn't|no longer) (exist|exists)( or has moved| or has been moved|)",
    "(please |)(try again|retry|refresh|reload|come back)( later| in a few minutes| in a moment| shortly| soon|)", "(return|go|go back|back|take me back) to (the |our |)(home|front|main|start)(page| page)", "check (the|your) (link|url|address|spelling)( and retry| and try again|)", "if the (problem|error|issue) (persists|continues)", "(contact|notify) (us|support|the administrator|the webmaster|the site owner|your administrator)", "(is |)(temporarily|currently) (unavailable|unable)", "(not found|not available|was not found|could not be found)",
    "(tick|check) the box( below|)( to show you are human|)", "(needs to |must |)(review|verify|check) the security of your connection( before proceeding|)", "(please |)(enable|allow|activate|turn on|switch on|turn them on|need to enable|requires|require|needs|need|without|works best with|is required|is disabled)", "(in|by|of) your (browser|web browser|settings)", "(and |)cookies", "to (continue|proceed|run this app|view this page|view this site|read this article|use this site|view it|function)", "(please |)wait( while|)", "(please |)(log|sign) in( again|)", "by (completing|clicking)", "the (link|address) you (followed|clicked|entered|typed)( may be broken| is broken|)", "(may be|is) (broken|misspelled|mistyped|incorrect)", "(check|come) back( in a minute| in a few minutes| later| soon|)", "briefly", "right now", "the (application|service|resource|administrator|owner)", "(http|error|status|code|status code|error code)", "from your network", "and (reload|refresh)", "security check", "on this server", "your (request|browser|connection|network)", "loading", "before (accessing|continuing|proceeding)", "due to", "at this time", "to complete your request", "was unable", "encountered", "try again", "performance (&|and) security", "ddos protection",
    # pt
    "(ops|opa)", "(desculpe|lamentamos|sentimos muito|pedimos desculpas)", "(a|esta|essa|sua) (página|conexão|rede)", "(o|este|seu|o seu) (site|endereço|link|arquivo|conteúdo|servidor|navegador|acesso|pedido)", "(que você|você) (procura|procurava|buscou|tentou acessar|está procurando)", "(digitado|digitada|solicitado|solicitada|informado)", "não existe( mais|)( ou mudou de lugar| ou foi removida| ou foi movida|)", "(tente|tentar) (novamente|de novo|outra vez)( mais tarde| em alguns minutos| em instantes| em alguns instantes|)", "(volte|voltar|retorne|retornar|ir) (para a|à|a) (página inicial|capa|home)", "(confira|verifique|cheque) se o (link|endereço) (está correto|foi digitado corretamente)", "se o (problema|erro) (persistir|continuar)", "(avise|contate|procure|fale com|entre em contato com) (a equipe técnica|a equipe|o administrador|o suporte)", "(detectamos|identificamos|percebemos)", "(na|em|da) sua (rede|conexão)", "marcando a caixa( abaixo|)", "(ative|habilite|permita|habilite-os|ligue|precisa de|requer|exige|necessita de|usa|desativado|desabilitado|está desativado)( o|)", "(no|em|do) (seu |)navegador", "(está|estão)( com|)", "(estão|está) (permitidos|permitido|ativados|ativado|habilitados|habilitado)", "e (recarregue|atualize)( a página|)", "para (ver|ler|exibir|acessar|continuar|funcionar|visualizar)( esta página| a matéria| este conteúdo|)", "(não é possível|impossível) (exibir|mostrar|carregar)( a| o|) (matéria|página|conteúdo)", "(aguarde|carregando)", "se nada aparecer", "verifique se", "este conteúdo", "temporariamente", "saiu do ar", "foi (removida|removido|movida)", "em (alguns|poucos) minutos", "erro", "voltamos (logo|em breve)", "por favor",
    # es
    "(lo sentimos|ups|vaya)", "(la|esta|su|tu) (página|conexión|red|dirección)", "(el|este|su|tu) (sitio|enlace|servidor|navegador|contenido)", "que (busca|buscas|está buscando|estás buscando|ha solicitado)", "(intente|inténtelo|inténtalo|intenta|vuelva a intentarlo|vuelve a intentarlo)( otra vez| de nuevo| nuevamente|)( en unos minutos| más tarde|)", "(vuelva|volver|vuelve|ir|regresar) a la (portada|página principal|página de inicio)", "no existe( o cambió de lugar| o ha sido eliminada|)", "si el problema (persiste|continúa)", "(habilite|habilita|active|activa|activar|habilitar|es necesario|necesita|requiere|necesario activar)( los| el|)", "(en|de) (su|tu) navegador", "para (continuar|ver|leer|usar)( esta página| este sitio|)", "(póngase en contacto|contacte) con el administrador", "espere( un momento|)", "por favor",
    # fr
    "(oups|désolé|nous sommes désolés)", "(la|cette|votre) (page|connexion)", "(le|ce|votre) (site|lien|navigateur|serveur|contenu)", "que vous (cherchez|recherchez|avez demandée)", "(veuillez |)(réessayer|réessayez)( plus tard| dans quelques minutes| dans un instant|)", "(retour|retourner|revenir) à (l'accueil|la page d'accueil)", "n'existe (pas|plus)( ou a changé| ou a été supprimée|)", "si le problème persiste", "(veuillez |)(activer|activez|autoriser|autorisez|nécessite|requiert)", "(dans|de) votre navigateur", "pour (continuer|lire|afficher|utiliser)( cet article| cette page| ce site|)", "contactez l'administrateur", "veuillez patienter", "a été supprimée",
    # de, it, nl, pl, ru, tr
    "(leider|entschuldigung|hoppla|ups)", "(die|diese|ihre) (seite|verbindung|anfrage)", "(die von ihnen|von ihnen) (gesuchte|angeforderte|aufgerufene)", "(bitte |)versuchen sie es (erneut|später erneut|später noch einmal|später)", "(zurück zur|zur) startseite", "(bitte |)(aktivieren sie|aktivieren|erlauben sie)", "(in|ihrem|in ihrem) browser", "(um|damit) (fortzufahren|diese seite)( anzuzeigen| zu sehen|)", "(fehler|bitte|warten|bitte warten)", "(ist|sind) (deaktiviert|erforderlich)",
    "(ci dispiace|spiacenti|ops)", "(la|questa) pagina", "che (cerchi|stai cercando)", "(riprova|riprovare)( più tardi| tra qualche minuto| tra poco|)", "(torna|ritorna) alla (home|homepage|pagina iniziale)", "(abilita|attiva|attivare|abilitare|abilitato|richiede)", "(nel|del) (tuo |)browser", "per (continuare|visualizzare|leggere)( questa pagina| questo sito|)", "errore",
    "(sorry|helaas|oeps)", "(de|deze) pagina", "die (u|je) zoekt", "probeer het (later |)(opnieuw|nog eens)", "(terug naar|naar) de (homepage|startpagina)", "(schakel|zet)", "(in|aan) (uw |je |)browser", "om (verder te gaan|door te gaan|deze pagina te bekijken)", "(is|staat) (uitgeschakeld|vereist)", "fout",
    "(przepraszamy|ups)", "(ta|żądana|szukana) strona", "spróbuj ponownie( później|)", "(wróć do|powrót do) strony głównej", "(włącz|włącz obsługę|wymaga)", "(w|swojej|w swojej) przeglądarce", "aby (kontynuować|wyświetlić stronę)", "błąd",
    "(извините|к сожалению|упс)", "(запрашиваемая|запрошенная|эта) страница", "(попробуйте|повторите попытку)( позже| ещё раз| еще раз|)", "(вернуться на|на) главную( страницу|)", "(включите|разрешите|необходимо включить|требуется)", "(в|вашем|в вашем|в настройках) браузере", "(чтобы|для) (продолжить|продолжения|просмотра)", "ошибка",
    "(üzgünüz|maalesef)", "(aradığınız|istediğiniz|bu) sayfa", "(lütfen |)(tekrar deneyin|daha sonra tekrar deneyin)", "ana sayfaya dön", "(etkinleştirin|etkinleştirmeniz gerekir)", "tarayıcınızda", "devam etmek için", "hata",
]
LOREM = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud ullamco laboris nisi aliquip commodo consequat "
    "nulla pariatur excepteur sint occaecat cupidatat proident mollit laborum vitae velit urna nunc augue donec libero ligula porta risus sapien semper tortor massa mauris lectus integer "
    "fringilla facilisis egestas curabitur pulvinar ornare vestibulum"
).split()


def phrases() -> dict[str, str]:
    """Phrase -> kind; of a phrase of several kinds the more telling one holds."""
    out: dict[str, str] = {}
    for kind, templates in (("related", RELATED), ("lorem", LOREM), ("filler", FILLER), ("error", ERROR), ("script", SCRIPT)):
        for t in templates:
            for x in spelled(t):
                out[x] = kind
                if x[-1] in "":
                    out.setdefault(x[:-1].rstrip("!"), kind)
    return out
