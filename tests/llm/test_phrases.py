"""Residue wording that the lexicon wasn't written from at first: default pages of servers, content systems, delivery networks and
browsers, in several languages, and ordinary sentences near them."""

import pytest

from tidemark.llm import residue
from tidemark.llm.phrases import spelled

HELD_OUT = [
    # servers and proxies
    "404 Not Found", "403 Forbidden", "502 Bad Gateway", "503 Service Temporarily Unavailable", "504 Gateway Time-out", "500 Internal Server Error", "400 Bad Request", "429 Too Many Requests", "405 Method Not Allowed", "413 Request Entity Too Large",
    "Not Found. The requested URL was not found on this server.", "Forbidden. You don't have permission to access this resource.", "HTTP Error 503. The service is unavailable.", "Server Error in '/' Application.", "The resource cannot be found.",
    "Error 503 Backend fetch failed", "The requested URL could not be retrieved", "HTTP Status 404 – Not Found", "Access Denied. You don't have permission to access this page on this server.", "An error occurred while processing your request.",
    # delivery networks and checks
    "Attention Required! | Cloudflare", "Just a moment...", "Checking your browser before accessing the site.", "Enable JavaScript and cookies to continue", "Please enable cookies. Sorry, you have been blocked", "Verify you are human by completing the action below.", "Error 1020 Access denied", "Please complete the security check to access", "Our systems have detected unusual traffic from your computer network.", "Pardon Our Interruption", "Are you a robot?", "Request blocked.",
    # content systems and applications
    "Oops! That page can't be found.", "It looks like nothing was found at this location. Maybe try a search?", "Error establishing a database connection", "Briefly unavailable for scheduled maintenance. Check back in a minute.", "The page you were looking for doesn't exist. You may have mistyped the address or the page may have moved.", "We're sorry, but something went wrong.", "Whoops, looks like something went wrong.", "Page not found | My site",
    "Sorry, this page isn't available. The link you followed may be broken, or the page may have been removed.", "This site can't be reached", "The website encountered an unexpected error. Please try again later.", "Your session has expired. Please log in again.", "This content isn't available right now", "This page is under construction", "Site is undergoing maintenance", "You need to enable JavaScript to run this app.", "Please turn on JavaScript in your browser and refresh the page to view its content.", "We're sorry but this app doesn't work properly without JavaScript enabled. Please enable it to continue.",
    # other languages
    "Erro 404 - Página não encontrada", "A página que você procura não existe ou foi removida.", "Erro interno do servidor", "Desculpe, não encontramos a página que você está procurando.", "Serviço temporariamente indisponível", "Para continuar, ative o JavaScript no seu navegador.", "Site em manutenção. Voltamos em breve!", "Ocorreu um erro inesperado. Tente novamente mais tarde.", "Verifique que você é humano",
    "Error 404: página no encontrada", "Lo sentimos, la página que buscas no existe.", "Ha ocurrido un error. Inténtelo de nuevo más tarde.", "Acceso denegado", "Por favor, activa JavaScript en tu navegador", "Sitio en mantenimiento",
    "Erreur 404 : page introuvable", "La page que vous recherchez n'existe pas.", "Une erreur est survenue, veuillez réessayer plus tard.", "Accès refusé", "Veuillez activer JavaScript dans votre navigateur pour continuer.",
    "Seite nicht gefunden", "Die von Ihnen gesuchte Seite existiert nicht.", "Fehler 404", "Zugriff verweigert", "Bitte aktivieren Sie JavaScript in Ihrem Browser.", "Wegen Wartungsarbeiten vorübergehend nicht erreichbar",
    "Pagina non trovata", "Errore 500 - Errore interno del server", "Accesso negato", "Pagina niet gevonden", "Toegang geweigerd", "Nie znaleziono strony", "Страница не найдена", "Доступ запрещён", "Ошибка 404", "Sayfa bulunamadı",
    # filler
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Your text here", "Hello world!", "Untitled Document", "Just another WordPress site", "Sample Page", "Insert title here", "Coming soon", "Texto de exemplo", "Insira seu texto aqui", "Texto de relleno", "Votre texte ici", "Beispieltext",
]
# A second list, written after the lexicon had been widened by what the first one showed; it was widened again after this one.
SECOND = [
    "401 Unauthorized", "410 Gone", "418 I'm a teapot", "451 Unavailable For Legal Reasons", "421 Misdirected Request", "507 Insufficient Storage", "HTTP ERROR 500", "This page isn't working right now", "The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.", "No such file or directory", "The file you requested was not found.", "Invalid request", "Bad Request - Invalid Hostname", "We couldn't find the page you were looking for.", "Sorry, the page you requested was not found.", "This video is unavailable", "Content not available in your region", "Your IP address has been blocked", "Too many login attempts. Please try again later.", "Please verify you are a human", "Loading, please wait...", "JavaScript is disabled in your browser.", "This site requires JavaScript.", "Erro ao carregar a página. Tente novamente.", "Página em construção", "O site está temporariamente fora do ar.", "Este conteúdo não está mais disponível.", "Acesso restrito", "Seu acesso foi bloqueado", "Conteúdo exclusivo para assinantes", "La página solicitada no existe", "Error al cargar la página", "Su sesión ha expirado", "Contenido no disponible", "Cette page n'existe plus", "Le service est momentanément indisponible", "Accès interdit", "Diese Website ist nicht erreichbar", "Ein Fehler ist aufgetreten", "Zugriff nicht erlaubt", "La pagina richiesta non esiste", "Si è verificato un errore", "Deze pagina bestaat niet", "Strona nie istnieje", "Такой страницы не существует", "Sayfa mevcut değil", "Title goes here", "Lorem ipsum", "Example page", "Test post please ignore",
]
ORDINARY = [
    "Access to the archive was denied to the families, the court heard", "O acesso negado aos autos motivou recurso da defesa", "The missing page of the register was found in a drawer", "Juiz manda retirar do ar página que ofendia testemunha", "La página perdida del expediente apareció en el archivo",
    "Servidor público é condenado por erro em processo", "Error judicial mantuvo preso a un inocente durante años", "La page la plus sombre de notre histoire", "Serviço de saúde indisponível agrava crise na prisão, diz relatório", "Test of the alarm system woke the prisoners",
    "Die Seite der Opfer wurde nicht gehört", "Museum closed for maintenance until the anniversary of the massacre", "404 presos foram transferidos em um só dia", "Coffee, cookies and the browser wars", "Programadores ensinam JavaScript a detentos da colônia penal", "Moment of silence for the victims", "A session expired without a vote on the pardon", "HTTP 503 em https://gazeta.example/noticia/123",
]


@pytest.mark.parametrize("wording", [HELD_OUT, SECOND])
def test_wording_from_elsewhere(wording):
    missed = [t for t in wording if residue.assess(t, True)[1] is None]
    assert len(missed) <= 0.15 * len(wording), missed


def test_ordinary_sentences():
    assert [t for t in ORDINARY if residue.assess(t, True)[1]] == []


def test_templates():
    assert spelled("(a|b) c( d|)") == ["a c", "a c d", "b c", "b c d"]
