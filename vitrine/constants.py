"""Fixed values.

Everything in this module is a value that must equal the source system's for
results to be right: column contracts, defaults, Portuguese calendar names,
period label formats, the keyword lexicon (in its declaration order, which is
the match priority), routing words, the metric glossary and the product
taxonomy. They are stated plainly, in their natural order, and are not
derived from anything.
"""

from __future__ import annotations

# ----------------------------------------------------------------------------
# FIXED VALUES: column contract of the landing file (25 columns, in order).
# ----------------------------------------------------------------------------
LANDING_COLUMNS = [
    "data", "ano", "mes", "ano_mes", "posicao_ranking", "categoria", "subcategoria",
    "id_anuncio", "titulo_produto", "marca", "preco_atual", "preco_original",
    "desconto_pct", "parcelamento", "qtd_vendas_estimadas_dia", "faturamento_estimado_dia",
    "avaliacao_nota", "qtd_avaliacoes", "is_full", "frete_gratis", "loja_oficial",
    "reputacao_vendedor", "url_imagem", "url_produto", "tipo_dado",
]

# Landing types (Spark DDL) used to add typed NULLs for missing columns.
LANDING_TYPES = {
    "data": "date", "ano": "int", "mes": "int", "ano_mes": "string",
    "posicao_ranking": "int", "categoria": "string", "subcategoria": "string",
    "id_anuncio": "string", "titulo_produto": "string", "marca": "string",
    "preco_atual": "string", "preco_original": "string", "desconto_pct": "int",
    "parcelamento": "string", "qtd_vendas_estimadas_dia": "string",
    "faturamento_estimado_dia": "string", "avaliacao_nota": "string",
    "qtd_avaliacoes": "int", "is_full": "bigint", "frete_gratis": "bigint",
    "loja_oficial": "string", "reputacao_vendedor": "string", "url_imagem": "string",
    "url_produto": "string", "tipo_dado": "string",
}

# FIXED VALUES: silver typing groups.
MONEY_COLUMNS = ["preco_atual", "preco_original", "faturamento_estimado_dia"]
RATING_COLUMN = "avaliacao_nota"
BOOLEAN_COLUMNS = ["is_full", "frete_gratis"]
INT_COLUMNS = ["ano", "mes", "posicao_ranking", "desconto_pct",
               "qtd_vendas_estimadas_dia", "qtd_avaliacoes"]
TRIM_COLUMNS = [
    "ano_mes", "categoria", "subcategoria", "id_anuncio",
    "titulo_produto", "marca", "parcelamento",
    "loja_oficial", "reputacao_vendedor",
    "url_imagem", "url_produto", "tipo_dado",
]

# FIXED VALUES: null defaults applied after deduplication (column, default).
NULL_DEFAULTS = [
    ("categoria", "Sem Categoria"),
    ("subcategoria", "Sem Subcategoria"),
    ("marca", "Sem Marca"),
    ("qtd_vendas_estimadas_dia", 0),
    ("faturamento_estimado_dia", 0.0),
    ("preco_atual", 0.0),
]

# FIXED VALUES: critical columns checked for NULLs after silver.
NULL_CHECK_COLUMNS = ["categoria", "subcategoria", "marca",
                      "qtd_vendas_estimadas_dia", "faturamento_estimado_dia"]

# FIXED VALUES: source provenance tags, in fallback order.
ORIGIN_FRESH = "GitHub_Cloud_Sync"
ORIGIN_EXISTING_FILE = "OneLake_Local_Files"
ORIGIN_TABLE_SNAPSHOT = "Delta_Snapshot"

# FIXED VALUES: gold schemas.
CALENDAR_COLUMNS = ["data", "ano", "mes", "dia", "ano_mes", "nome_mes", "trimestre",
                    "dia_semana", "dia_semana_num", "is_fim_semana", "semana_do_ano"]
PRODUCT_COLUMNS = ["id_anuncio", "titulo_produto", "marca", "avaliacao_nota",
                   "qtd_avaliacoes", "is_full", "frete_gratis", "loja_oficial",
                   "reputacao_vendedor", "url_imagem", "url_produto"]
FACT_COLUMNS = ["data", "sk_produto", "sk_categoria", "posicao_ranking", "qtd_vendas",
                "faturamento", "preco_atual", "preco_original", "desconto_pct",
                "parcelamento", "tipo_dado", "ano_mes"]
ANALYTIC_COLUMNS = ["data", "ano", "mes", "ano_mes", "posicao_ranking", "categoria",
                    "subcategoria", "titulo_produto", "marca", "qtd_vendas_num",
                    "fat_num", "preco_num", "is_full", "frete_gratis"]

# FIXED VALUES: Portuguese month names (1..12) and weekday names (1=Sunday..7).
MONTH_NAMES = ["Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho", "Julho",
               "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]
WEEKDAY_NAMES = ["Domingo", "Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado"]
WEEKEND_DAYS = [1, 7]

# FIXED VALUES: period labels. {ref} and {day} are ISO dates, {mm} two digits.
LABEL_TODAY = "Hoje ({ref})"
LABEL_YESTERDAY = "Ontem ({day})"
LABEL_MTD = "MTD (Acumulado no Mês {mm}/{yyyy} até {ref})"
LABEL_YTD = "YTDA {yyyy} (Acumulado no Ano até {ref})"
LABEL_ISO_DATE = "Data {day}"
LABEL_BR_DATE = "Data {dd}/{mm}/{yyyy}"

# ----------------------------------------------------------------------------
# FIXED VALUES: keyword lexicon. Order is the match priority (first wins).
# Category keywords -> category.
# ----------------------------------------------------------------------------
CATEGORY_KEYWORDS = [
    ("informatica", "Informática"), ("informática", "Informática"), ("ti", "Informática"),
    ("celular", "Celulares e Telefones"), ("celulares", "Celulares e Telefones"),
    ("telefone", "Celulares e Telefones"), ("telefones", "Celulares e Telefones"),
    ("eletro", "Eletrodomésticos"), ("eletros", "Eletrodomésticos"),
    ("eletrodoméstico", "Eletrodomésticos"), ("eletrodomésticos", "Eletrodomésticos"),
    ("eletrodomestico", "Eletrodomésticos"), ("eletrodomesticos", "Eletrodomésticos"),
    ("ferramenta", "Ferramentas e Construção"), ("ferramentas", "Ferramentas e Construção"),
    ("construcao", "Ferramentas e Construção"), ("construção", "Ferramentas e Construção"),
    ("casa", "Casa, Móveis e Decoração"), ("moveis", "Casa, Móveis e Decoração"),
    ("móveis", "Casa, Móveis e Decoração"), ("decoracao", "Casa, Móveis e Decoração"),
    ("decoração", "Casa, Móveis e Decoração"),
]

# Subcategory keywords -> (parent category or None when shared, subcategory).
SUBCATEGORY_KEYWORDS = [
    ("smartphones", "Celulares e Telefones", "Smartphones"),
    ("smartphone", "Celulares e Telefones", "Smartphones"),
    ("áudio mobile", "Celulares e Telefones", "Áudio Mobile"),
    ("audio mobile", "Celulares e Telefones", "Áudio Mobile"),
    ("automobile", "Celulares e Telefones", "Áudio Mobile"),
    ("auto mobile", "Celulares e Telefones", "Áudio Mobile"),
    ("audiomobile", "Celulares e Telefones", "Áudio Mobile"),
    ("som mobile", "Celulares e Telefones", "Áudio Mobile"),
    ("fone de ouvido", "Celulares e Telefones", "Áudio Mobile"),
    ("fones de ouvido", "Celulares e Telefones", "Áudio Mobile"),
    ("fones", "Celulares e Telefones", "Áudio Mobile"),
    ("fone", "Celulares e Telefones", "Áudio Mobile"),
    ("airpods", "Celulares e Telefones", "Áudio Mobile"),
    ("airpod", "Celulares e Telefones", "Áudio Mobile"),
    ("headset", "Celulares e Telefones", "Áudio Mobile"),
    ("tws", "Celulares e Telefones", "Áudio Mobile"),
    ("carregadores", "Celulares e Telefones", "Carregadores"),
    ("carregador", "Celulares e Telefones", "Carregadores"),
    ("smartwatches", "Celulares e Telefones", "Smartwatches"),
    ("smartwatch", "Celulares e Telefones", "Smartwatches"),
    ("relogio", "Celulares e Telefones", "Smartwatches"),
    ("relógio", "Celulares e Telefones", "Smartwatches"),
    ("cabos", "Celulares e Telefones", "Cabos"),
    ("cabo", "Celulares e Telefones", "Cabos"),
    ("adaptadores", "Celulares e Telefones", "Adaptadores"),
    ("adaptador", "Celulares e Telefones", "Adaptadores"),
    ("suportes", "Celulares e Telefones", "Suportes"),
    ("suporte", "Celulares e Telefones", "Suportes"),
    ("memória", "Celulares e Telefones", "Memória"),
    ("memoria", "Celulares e Telefones", "Memória"),
    ("notebooks", "Informática", "Notebooks"),
    ("notebook", "Informática", "Notebooks"),
    ("laptop", "Informática", "Notebooks"),
    ("laptops", "Informática", "Notebooks"),
    ("hardware", "Informática", "Hardware"),
    ("placa de vídeo", "Informática", "Hardware"),
    ("placa de video", "Informática", "Hardware"),
    ("processador", "Informática", "Hardware"),
    ("periféricos", "Informática", "Periféricos"),
    ("perifericos", "Informática", "Periféricos"),
    ("periférico", "Informática", "Periféricos"),
    ("periferico", "Informática", "Periféricos"),
    ("mouse", "Informática", "Periféricos"),
    ("teclado", "Informática", "Periféricos"),
    ("armazenamento", "Informática", "Armazenamento"),
    ("ssd", "Informática", "Armazenamento"),
    ("hd", "Informática", "Armazenamento"),
    ("pendrive", "Informática", "Armazenamento"),
    ("monitores", "Informática", "Monitores"),
    ("monitor", "Informática", "Monitores"),
    ("games", "Informática", "Games"),
    ("gamer", "Informática", "Games"),
    ("jogos", "Informática", "Games"),
    ("redes", "Informática", "Redes"),
    ("roteador", "Informática", "Redes"),
    ("roteadores", "Informática", "Redes"),
    ("impressão 3d", "Informática", "Impressão 3D"),
    ("impressao 3d", "Informática", "Impressão 3D"),
    ("energia", "Informática", "Energia"),
    ("nobreak", "Informática", "Energia"),
    ("áudio pc", "Informática", "Áudio PC"),
    ("audio pc", "Informática", "Áudio PC"),
    ("suprimentos", "Informática", "Suprimentos"),
    ("toner", "Informática", "Suprimentos"),
    ("cartucho", "Informática", "Suprimentos"),
    ("impressão", "Informática", "Impressão"),
    ("impressao", "Informática", "Impressão"),
    ("impressora", "Informática", "Impressão"),
    ("climatização", "Eletrodomésticos", "Climatização"),
    ("climatizacao", "Eletrodomésticos", "Climatização"),
    ("ar condicionado", "Eletrodomésticos", "Climatização"),
    ("ventilador", "Eletrodomésticos", "Climatização"),
    ("aquecedor", "Eletrodomésticos", "Climatização"),
    ("purificadores", "Eletrodomésticos", "Purificadores"),
    ("purificador", "Eletrodomésticos", "Purificadores"),
    ("refrigeração", "Eletrodomésticos", "Refrigeração"),
    ("refrigeracao", "Eletrodomésticos", "Refrigeração"),
    ("geladeira", "Eletrodomésticos", "Refrigeração"),
    ("freezer", "Eletrodomésticos", "Refrigeração"),
    ("cuidados roupas", "Eletrodomésticos", "Cuidados Roupas"),
    ("ferro de passar", "Eletrodomésticos", "Cuidados Roupas"),
    ("eletroportáteis", "Eletrodomésticos", "Eletroportáteis"),
    ("eletroportateis", "Eletrodomésticos", "Eletroportáteis"),
    ("air fryer", "Eletrodomésticos", "Eletroportáteis"),
    ("fritadeira", "Eletrodomésticos", "Eletroportáteis"),
    ("cafeteira", "Eletrodomésticos", "Eletroportáteis"),
    ("bebedouros", "Eletrodomésticos", "Bebedouros"),
    ("bebedouro", "Eletrodomésticos", "Bebedouros"),
    ("manuais", "Ferramentas e Construção", "Manuais"),
    ("ferramentas manuais", "Ferramentas e Construção", "Manuais"),
    ("elétrica", "Ferramentas e Construção", "Elétrica"),
    ("eletrica", "Ferramentas e Construção", "Elétrica"),
    ("elétricas", "Ferramentas e Construção", "Elétricas"),
    ("eletricas", "Ferramentas e Construção", "Elétricas"),
    ("furadeira", "Ferramentas e Construção", "Elétricas"),
    ("parafusadeira", "Ferramentas e Construção", "Elétricas"),
    ("construção", "Ferramentas e Construção", "Construção"),
    ("construcao", "Ferramentas e Construção", "Construção"),
    ("pintura", "Ferramentas e Construção", "Pintura"),
    ("tinta", "Ferramentas e Construção", "Pintura"),
    ("medição", "Ferramentas e Construção", "Medição"),
    ("medicao", "Ferramentas e Construção", "Medição"),
    ("trena", "Ferramentas e Construção", "Medição"),
    ("hidráulica", "Ferramentas e Construção", "Hidráulica"),
    ("hidraulica", "Ferramentas e Construção", "Hidráulica"),
    ("pneumática", "Ferramentas e Construção", "Pneumática"),
    ("pneumatica", "Ferramentas e Construção", "Pneumática"),
    ("solda", "Ferramentas e Construção", "Solda"),
    ("cama e banho", "Casa, Móveis e Decoração", "Cama e Banho"),
    ("lencol", "Casa, Móveis e Decoração", "Cama e Banho"),
    ("lençol", "Casa, Móveis e Decoração", "Cama e Banho"),
    ("toalha", "Casa, Móveis e Decoração", "Cama e Banho"),
    ("móveis", "Casa, Móveis e Decoração", "Móveis"),
    ("moveis", "Casa, Móveis e Decoração", "Móveis"),
    ("sofa", "Casa, Móveis e Decoração", "Móveis"),
    ("sofá", "Casa, Móveis e Decoração", "Móveis"),
    ("decoração", "Casa, Móveis e Decoração", "Decoração"),
    ("decoracao", "Casa, Móveis e Decoração", "Decoração"),
    ("banheiro", "Casa, Móveis e Decoração", "Banheiro"),
    ("iluminação", "Casa, Móveis e Decoração", "Iluminação"),
    ("iluminacao", "Casa, Móveis e Decoração", "Iluminação"),
    ("luminária", "Casa, Móveis e Decoração", "Iluminação"),
    ("organização", "Casa, Móveis e Decoração", "Organização"),
    ("organizacao", "Casa, Móveis e Decoração", "Organização"),
    ("utilidades", "Casa, Móveis e Decoração", "Utilidades"),
    ("utensílios", "Casa, Móveis e Decoração", "Utensílios de Cozinha"),
    ("utensilios", "Casa, Móveis e Decoração", "Utensílios de Cozinha"),
    ("artigos de festas", "Casa, Móveis e Decoração", "Artigos de Festas"),
    ("jardim", "Casa, Móveis e Decoração", "Jardim"),
    ("malas", "Casa, Móveis e Decoração", "Malas"),
    ("cozinha", None, "Cozinha"),
    ("limpeza", None, "Limpeza"),
    ("lavanderia", None, "Lavanderia"),
    ("segurança", None, "Segurança"),
    ("seguranca", None, "Segurança"),
    ("acessórios", None, "Acessórios"),
    ("acessorios", None, "Acessórios"),
]

# ----------------------------------------------------------------------------
# FIXED VALUES: routing words (all matched on the lower-cased, trimmed text).
# ----------------------------------------------------------------------------
GREETING_COMMANDS = ["/start", "/ajuda", "oi", "ola", "olá", "start"]
DEMO_WORD = "slide"
DEMO_CONTEXT_WORDS = ["exemplo", "caso"]
LIST_CATEGORIES_PHRASES = ["quais sao as categorias", "quais são as categorias",
                           "quais categorias", "listar categorias", "quais as categorias"]
SUBCATEGORIES_OF_PATTERN = r"(?:subcategorias|subcategoria)\s+(?:de|da|do)\s+([a-z0-9áéíóúãõç\s,]+)"
SALES_WORDS_BLOCKING_LIST = ["vendeu", "venda", "faturamento", "faturou", "quanto", "ranking"]
CONCEPT_PREFIXES = ["o que e", "o que é", "o que significa", "significado de",
                    "definicao de", "definição de", "conceito de"]
SUBCATEGORY_SYNONYMS = ["subcategoria", "subcategorias", "subcategira", "sub-categoria",
                        "sub categoria", "subcat", "sub-cat", "sub-categ"]
CATEGORY_SYNONYMS = ["categoria", "categorias", "categora", "cat", "categor"]
DYNAMIC_SUBCATEGORY_PATTERN = (r"(?:subcategoria|subcategorias|subcategira|sub-categoria|"
                               r"sub categoria|subcat)\s+(?:de\s+|da\s+|do\s+)?([a-z0-9áéíóúãõç\s]+)")
DYNAMIC_STOP_PHRASES = ["no mtd", "no ytda", "hoje", "ontem", "no ano", "no mes"]
YTD_WORDS = ["ytda", "ytd", "acumulado no ano", "acumulado do ano", "no ano",
             "deste ano", "ano atual"]
MTD_WORDS = ["mtd", "acumulado no mês", "acumulado no mes", "acumulado do mês",
             "acumulado do mes", "no mês", "no mes", "deste mês", "deste mes",
             "mês atual", "mes atual"]
YESTERDAY_WORDS = ["ontem"]
METADATA_WORD = "data"
METADATA_WORDS = ["recente", "ultima", "última", "atualizada", "base"]
METADATA_EXCLUSIONS = ["venda", "fatur", "quanto", "categoria", "ytda", "mtd"]
RANKING_WORDS_SUBCATEGORY = ["todas", "ranking", "quais", "mais vendid", "maior", "cada",
                             "por subcategoria"]
RANKING_WORDS_CATEGORY = ["todas", "ranking", "quais", "mais vendid", "maior", "cada",
                          "por categoria"]
PRODUCT_WORDS = ["produto", "anuncio", "anúncio", "item", "mais vendido", "mais vendid"]
TOTAL_WORDS = ["total", "geral", "faturamento", "faturou", "vendas", "vendeu", "resultado"]
TOTAL_EXCLUSIONS = ["produto", "anuncio", "item", "marca"]
BULLET_ROWS = 8
PIPE_TABLE_ROWS = 15
MONEY_NAME_PARTS_SINGLE = ["fat", "preco", "ticket", "receita"]
MONEY_NAME_PARTS_LIST = ["fat", "preco"]
DEFAULT_USER_NAME = "Parceiro"

# FIXED VALUES: reply texts.
WARN_SUB_AS_CATEGORY_WITH_PARENT = (
    "💡 *Aviso Didático:* Olha, o que você pediu como categoria (*'{sub}'*) não existe "
    "como Categoria porque na verdade é uma **Subcategoria**! A categoria mãe dela é **'{parent}'**.")
WARN_SUB_AS_CATEGORY = (
    "💡 *Aviso Didático:* Olha, o que você pediu como categoria (*'{sub}'*) não existe "
    "como Categoria porque na verdade é uma **Subcategoria**.")
WARN_CATEGORY_AS_SUB = (
    "💡 *Aviso Didático:* Olha, você pesquisou como subcategoria, mas **'{cat}'** é uma "
    "**Categoria principal** (Nível 1), e não uma subcategoria!")
REPLY_HEADER = "📊 *Olá {user}! Pesquisei aqui vejamos o resultado:*\n"
REPLY_QUESTION = "🔍 _\"{question}\"_\n"
REPLY_MORE = "\n_... e mais {n} registros encontrados._"
REPLY_FOOTER = "\n📌 _Dados oficiais · Atualizado até {ref}_"
REPLY_EMPTY = "Fala {user}! Não encontrei registros na base oficial para a sua pergunta."
MARKUP_CHARS = "*#_`~[]()><"
REPLY_GLOSSARY = "📖 *Termo:* `{sigla}` ({termo})\n💡 *Definição Oficial:* {definicao}"
REPLY_GREETING = "👋 *Olá {user}!*\n📅 *Base atualizada até:* `{ref}` ({rows} registros)."

# ----------------------------------------------------------------------------
# FIXED VALUES: glossary of metric and time terms (termo, sigla, explicacao).
# ----------------------------------------------------------------------------
GLOSSARY = [
    ("Year to Date", "YTDA", "Acumulado Ano"),
    ("Month to Date", "MTD", "Acumulado Mês"),
    ("Month over Month", "MoM", "Mês ano atual /Mesmo Mês ano anterior"),
    ("Year over Year", "YoY", "Ano /ano anterior"),
    ("Mes Anterior", "M-1", "Mes Anterior"),
    ("Mês posterior", "M+1", "Mês posterior"),
    ("Orçado", "O", "Orçado"),
    ("Realizado", "R", "Realizado"),
    ("Forecast", "F", "Forecast"),
    ("Real + Forecast", "R+F", "Real + Forecast"),
    ("Desafio", "D", "Desafio"),
    ("Last Year", "LY", "Ano Passado"),
    ("Variação Absoluta", "∆ ABS", "Variação Absoluta"),
    ("Variação Percentual", "∆ %", ""),
    ("Faturamento_Estimado_Dia.", "Faturamento", "É o Preço_Atual x QTD_Vendas"),
    ("QTD_Vendas", "Vendas", "É a quantidade de vendas em Unidades"),
    ("QTD_Vendas", "Vendeu", "É a quantidade de vendas em Unidades"),
    ("Preco_Atual.", "Preço", "É o Preço no momento mais recente"),
    ("Qtd_Avaliacoes.", "Avaliações", "É a quantidade de avaliações feitas pelas pessoas"),
    ("Preco_Original.", "Preço Inicial", "É o preço inicial"),
    ("Avaliacao_Nota.", "Avaliação", "É a nota dada na avaliação"),
    ("Avaliacao_Nota.", "Nota", "É a avaliação onde será atribuida uma nota"),
    ("desconto_pct", "Em %", "Em %"),
    ("frete_gratis", "Sim ou Não", "Sim ou Não"),
    ("id_anuncio", "Codigo de Anuncio", "Codigo de Anuncio"),
    ("loja_oficial", "Da Marca ou Market Place", "Da Marca ou Market Place"),
    ("reputação_vendedor", "Mercado Lider Platinum", "Mercado Lider Platinum"),
    ("tipo_dado", "Oficial ou Sintetico", "Oficial ou Sintetico"),
    ("url_imagem", "caminho imagem", "caminho imagem"),
    ("url_produto", "caminho produto", "caminho produto"),
]

# ----------------------------------------------------------------------------
# FIXED VALUES: product taxonomy, category -> subcategory -> example brands,
# in the dictionary's order.
# ----------------------------------------------------------------------------
TAXONOMY = {
    "Casa, Móveis e Decoração": {
        "Cama e Banho": ["Altenburg", "Fibrasca", "Casa Laura", "Kacyumara", "Santista",
                         "Buddemeyer", "Enxoval.com", "Ortobom"],
        "Cozinha": ["Dohler", "Mak-Inox", "Wellmix", "Brinox", "Tramontina"],
        "Decoração": ["Herweg", "DcorHome", "ArteQuadros", "Texfine", "Premier", "Luizatex"],
        "Móveis": ["SuedeArt", "ArtFactory", "Notável", "Araplac", "Conforsit", "MobiStore",
                   "Madesa"],
        "Iluminação": ["Importado", "Positivo", "G-Light"],
        "Organização": ["Buba", "VbHome", "Paramount"],
        "Banheiro": ["Astra", "Future", "Pingoo"],
        "Utensílios de Cozinha": ["Tramontina"],
        "Artigos de Festas": ["Festcolor"],
        "Utilidades": ["Tramontina", "Oikos"],
        "Lavanderia": ["Oikos", "Mor"],
        "Segurança": ["Woosh", "Intelbras"],
        "Jardim": ["Marqs Home"],
        "Limpeza": ["FlashLimp"],
        "Malas": ["Santino"],
    },
    "Celulares e Telefones": {
        "Carregadores": ["Boyu Cell", "Baseus", "Samsung", "Geonav", "Apple", "Hardline"],
        "Smartphones": ["Xiaomi", "Apple", "Motorola", "Samsung"],
        "Áudio Mobile": ["JBL", "Xiaomi", "Soundcore", "Apple", "QCY"],
        "Acessórios": ["Hprime", "Customic", "SportFit"],
        "Cabos": ["Ugreen", "Apple"],
        "Suportes": ["Ugreen", "Baseus"],
        "Adaptadores": ["Samsung", "Apple"],
        "Memória": ["SanDisk"],
        "Smartwatches": ["Xiaomi", "Samsung"],
    },
    "Eletrodomésticos": {
        "Cozinha": ["Lenoxx", "Britânia", "Cadence", "Unitermi", "Elgin", "Philips Walita",
                    "Mueller", "Suggar", "Itatiaia", "Arno", "Três Corações", "Oster",
                    "Electrolux", "Philco", "Mondial"],
        "Climatização": ["Fisher Price", "Ventisol", "Mondial"],
        "Purificadores": ["Consul", "Electrolux"],
        "Eletroportáteis": ["SF-400"],
        "Limpeza": ["Mondial", "WAP"],
        "Cuidados Roupas": ["Arno", "Black+Decker"],
        "Lavanderia": ["Mueller", "Midea", "Electrolux"],
        "Bebedouros": ["Esmaltec"],
        "Refrigeração": ["Brastemp", "Consul"],
    },
    "Ferramentas e Construção": {
        "Elétrica": ["3M", "LEF", "Margirius", "Minipa", "Clamper", "Parosflux", "Lorenzetti"],
        "Manuais": ["Gedore", "Sparta", "Vonder", "Tramontina"],
        "Elétricas": ["Gamma", "Mondial", "DeWalt", "Bosch", "Makita"],
        "Construção": ["Tekbond", "Pulvitec", "Dryko", "Mor"],
        "Acessórios": ["Groove", "Tramontina", "Norton", "Bosch"],
        "Pintura": ["Tramontina", "3M", "Atlas", "Steula"],
        "Medição": ["Sparta", "Lufkin", "Mileseey"],
        "Hidráulica": ["Camperluz"],
        "Segurança": ["Titanium"],
        "Iluminação": ["Avant"],
        "Limpeza": ["WAP", "Kärcher"],
        "Solda": ["Boxer"],
        "Pneumática": ["Chiaperini"],
    },
    "Informática": {
        "Hardware": ["Arctic", "Corsair", "Asus", "Rise Mode", "AMD", "Kingston", "Galax"],
        "Periféricos": ["Redragon", "Logitech"],
        "Armazenamento": ["SanDisk", "Kingston"],
        "Redes": ["Furukawa", "TP-Link"],
        "Acessórios": ["Baseus", "Exbom", "ELG"],
        "Impressão 3D": ["Masterprint", "Voolt3D"],
        "Games": ["Microsoft", "Nintendo", "Sony"],
        "Notebooks": ["Apple", "Acer", "Lenovo", "Asus", "Dell", "Samsung"],
        "Energia": ["Clamper"],
        "Monitores": ["LG"],
        "Áudio PC": ["Redragon"],
        "Suprimentos": ["Epson"],
        "Móveis PC": ["ThunderX3"],
        "Impressão": ["Epson"],
    },
}
