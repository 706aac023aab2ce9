"""Words, codes, column lists and messages that outputs must carry as they are."""

from __future__ import annotations

# --- fixed values: markers that mean "no value" in a text cell
NULL_MARKERS = ["", "NONE", "NULL", "NAN", "NAT"]

# --- fixed values: cell texts a delimited reader takes as missing
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: words for yes and no
YES_WORDS = ["1", "true", "yes", "y", "on", "oui"]
NO_WORDS = ["0", "false", "no", "n", "off", "non"]

# --- fixed values: document types
FACTURE = "FACTURE"
AVOIR = "AVOIR"
UNKNOWN = "UNKNOWN"

# --- fixed values: statuses
OK = "OK"
MISSING = "MANQUANTE_RCI"
OUT_OF_SCOPE = "HORS_SCOPE_RCI"
OUT_OF_PERIOD = "RCI_HORS_PERIODE"
BANK_ONLY = "RCI_SEULEMENT"
AMOUNT_GAP = "ANOMALIE_MONTANT"
DATE_GAP = "ANOMALIE_DATE"
DUPLICATE = "DOUBLON"

STATUS_ORDER = [OK, MISSING, OUT_OF_SCOPE, OUT_OF_PERIOD, BANK_ONLY, AMOUNT_GAP, DATE_GAP, DUPLICATE]
ANALYSED = [OK, MISSING, OUT_OF_SCOPE, AMOUNT_GAP, DATE_GAP, DUPLICATE]
MATCHABLE = [OK, MISSING, AMOUNT_GAP, DATE_GAP, DUPLICATE]
GAPS = [MISSING, BANK_ONLY, AMOUNT_GAP, DATE_GAP, DUPLICATE]
NOT_ANOMALIES = [OK, OUT_OF_SCOPE, OUT_OF_PERIOD]

# --- fixed values: priority and recommended action per status
PRIORITY = {
    OK: "BASSE",
    DATE_GAP: "MOYENNE",
    BANK_ONLY: "MOYENNE",
    OUT_OF_PERIOD: "BASSE",
    MISSING: "HAUTE",
    AMOUNT_GAP: "HAUTE",
    DUPLICATE: "HAUTE",
    OUT_OF_SCOPE: "BASSE",
}
ACTION = {
    OK: "Aucune action requise.",
    MISSING: "Vérifier la transmission vers RCI et préparer un renvoi si nécessaire.",
    OUT_OF_SCOPE: "Vérifier si le concessionnaire doit être ajouté au référentiel RCI.",
    OUT_OF_PERIOD: "Contrôler la période du fichier RCI/PDF chargé.",
    AMOUNT_GAP: "Comparer le montant ERP avec le montant RCI.",
    DATE_GAP: "Comparer la date ERP avec la date RCI/PDF.",
    DUPLICATE: "Vérifier les doublons dans les fichiers source.",
    BANK_ONLY: "Vérifier origine côté RCI ou historique ERP.",
}
ACTION_OTHERWISE = "Analyser l'écart et définir une action de régularisation."

# --- fixed values: severities in rank order, and the two amount limits
SEVERITIES = ["CRITIQUE", "ELEVEE", "MOYENNE", "A_VERIFIER", "INFORMATION", "OK"]
CRITICAL_FROM = 100000
HIGH_FROM = 20000

# --- fixed values: categories of missing documents
MISSING_INVOICE = "Facture absente"
MISSING_CREDIT = "Avoir absent"
MISSING_UNKNOWN = "Non déterminé"
MISSING_CATEGORIES = [MISSING_INVOICE, MISSING_CREDIT, MISSING_UNKNOWN]

# --- fixed values: label for an absent customer
NO_NAME = "NON RENSEIGNE"
NO_NAME_CHART = "Non renseigné"
NO_DATE = "DATE_NON_RENSEIGNEE"

# --- fixed values: comments
COMMENT_OUT_OF_PERIOD_ROW = "Hors période de rapprochement"
COMMENT_OUT_OF_PERIOD = "Flux RCI/PDF hors période de rapprochement"
COMMENT_MISSING = "Présent dans le batch ERP mais absent du batch RCI."
COMMENT_IN_FILTER = "Dans la période filtrée"
COMMENT_OUT_FILTER = "Hors période filtrée - vérifier filtre date"
COMMENT_NO_REFERENCE = "Référentiel RCI indisponible pour comparaison"
COMMENT_NEAR_NAME = "Nom proche du référentiel RCI - vérifier une différence de libellé"
COMMENT_NO_NEAR_NAME = "Aucun reclassement automatique - validation métier nécessaire"
SUGGESTION = "Vérifier si le concessionnaire doit être ajouté au référentiel RCI."
BATCH_WARNING = "Fichier candidat à valider par l’équipe facturation avant transmission à RCI."
NO_BATCH_MESSAGE = (
    "Aucun batch correctif candidat généré : aucune facture ou avoir prioritaire absent côté RCI."
)
NO_PERIOD_LABEL = "filtre desactive"

# --- fixed values: alert texts of the audit
ALERT_MISSING_PERIOD = "Des MANQUANTE_RCI ont une date ERP hors période filtrée."
ALERT_LOW_RATE = "Le taux de rapprochement est inférieur à 70%."
ALERT_SCOPE = "Plus de 20% des factures sont hors périmètre RCI."
ALERT_NO_FEED = "Attention : aucun flux RCI dans la période de rapprochement."

# --- fixed values: column lists of the tables
ERP_COLUMNS = [
    "source_file", "source_sheet", "invoice_number", "document_type", "erp_date", "customer_code",
    "customer_name", "amount_erp", "department_code", "brand_code", "sales_order_type",
]
RCI_COLUMNS = [
    "source_file", "invoice_number", "document_type", "rci_date", "dealer_code", "amount_rci", "raw_line",
]
PDF_COLUMNS = [
    "source_file", "page", "dealer_code", "invoice_number", "document_type", "cf_code",
    "pdf_invoice_date", "due_date", "model", "chassis_number", "amount_pdf", "origin", "raw_line",
]
RECONCILIATION_COLUMNS = [
    "invoice_number", "document_type", "customer_code", "customer_name", "is_rci_covered",
    "amount_erp", "amount_rci", "amount_pdf", "amount_gap", "montant_impacte", "erp_date",
    "rci_date", "pdf_invoice_date", "due_date", "origin", "status", "priority", "severity",
    "included_in_corrective_batch", "action_recommandee", "source_erp", "source_rci", "source_pdf",
    "commentaire_audit",
]
HISTORY_COLUMNS = [
    "processing_date", "processing_run_id", "invoice_number", "document_type", "customer_code",
    "customer_name", "is_rci_covered", "amount_erp", "amount_rci", "amount_pdf", "amount_gap",
    "montant_impacte", "erp_date", "pdf_invoice_date", "due_date", "origin", "status", "priority",
    "severity", "included_in_corrective_batch", "action_recommandee",
]
SOURCE_ROW_COLUMNS = [
    "source_type", "source_file", "file_name", "source_sheet", "page", "invoice_number",
    "document_type", "erp_date", "customer_code", "customer_name", "is_rci_covered", "amount_erp",
    "department_code", "brand_code", "sales_order_type", "rci_date", "dealer_code", "amount_rci",
    "cf_code", "pdf_invoice_date", "due_date", "model", "chassis_number", "amount_pdf", "origin",
    "raw_line", "file_path", "extension", "size_bytes", "modified_at", "status", "ingested_at",
]
MISSING_COLUMNS = [
    "categorie", "severity", "invoice_number", "document_type", "erp_date", "due_date",
    "customer_code", "customer_name", "amount_erp", "montant_impacte", "status",
    "action_recommandee", "included_in_corrective_batch", "source_erp", "source_rci", "source_pdf",
    "commentaire_audit",
]
MISSING_HEADERS = {
    "categorie": "Catégorie",
    "severity": "Sévérité",
    "invoice_number": "N° facture / avoir",
    "document_type": "Type document",
    "erp_date": "Date facture ERP",
    "due_date": "Date échéance",
    "customer_code": "Code concessionnaire",
    "customer_name": "Concessionnaire",
    "amount_erp": "Montant ERP",
    "montant_impacte": "Montant impacté",
    "status": "Statut",
    "action_recommandee": "Action recommandée",
    "included_in_corrective_batch": "Inclus batch correctif",
    "source_erp": "Source ERP",
    "source_rci": "Source RCI",
    "source_pdf": "Source PDF",
    "commentaire_audit": "Commentaire audit",
}
CONTROL_COLUMNS = [
    "invoice_number", "erp_date", "customer_name", "amount_erp", "montant_impacte", "severity",
    "status", "action_recommandee", "included_in_corrective_batch",
]
BATCH_COLUMNS = ["invoice_number", "erp_date", "customer_name", "amount_erp", "montant_impacte", "severity"]
ACTION_PLAN_COLUMNS = [
    "severity", "invoice_number", "erp_date", "customer_name", "amount_erp", "amount_rci",
    "amount_pdf", "montant_impacte", "status", "action_recommandee", "source_erp", "source_rci",
    "source_pdf",
]
OUT_OF_PERIOD_COLUMNS = [
    "invoice_number", "document_type", "rci_date", "pdf_invoice_date", "amount_rci", "amount_pdf",
    "source_rci", "source_pdf", "status", "montant_impacte", "commentaire_audit",
]

# --- fixed values: header aliases of ERP exports, targets and aliases in rank order
ERP_ALIASES = {
    "invoice_number": [
        "No facture", "N facture", "Numero facture", "Num facture", "Facture", "Numero", "No", "N",
    ],
    "erp_date": [
        "Date comptabilisation", "Date facture", "Date de comptabilisation", "Date document", "Date",
    ],
    "amount_erp": ["Montant TTC", "Total TTC", "Montant", "Total"],
    "customer_code": [
        "No donneur d'ordre", "Numero donneur d'ordre", "Code donneur d'ordre", "No concession",
        "Numero concession", "Numero CNC", "No CNC", "CNC", "Numero client facture", "No client facture",
    ],
    "customer_name": [
        "Nom du donneur d'ordre", "Nom donneur d'ordre", "Nom", "Client", "Concessionnaire", "Concession",
    ],
    "department_code": ["Code departement", "Departement", "CTG"],
    "brand_code": ["Code marque", "Marque", "MQ"],
    "sales_order_type": ["Type Commande Vente", "Type commande", "Commande vente", "Type vente"],
}

# --- fixed values: header aliases of bank tables, targets and aliases in rank order
RCI_ALIASES = {
    "invoice_number": [
        "No facture", "N facture", "Numero facture", "Num facture", "Facture", "Invoice",
        "Invoice number", "Document",
    ],
    "rci_date": [
        "Date", "Date RCI", "Date operation", "Date comptabilisation", "Date facture", "Accounting date",
    ],
    "dealer_code": [
        "Dealer", "Dealer code", "Code dealer", "Code concession", "Concession", "Donneur ordre",
        "Code donneur ordre",
    ],
    "amount_rci": ["Montant", "Montant RCI", "Montant TTC", "Total TTC", "Amount", "Total"],
}

# --- fixed values: header words of coverage lists
REFERENCE_CODE_WORDS = [
    "code", "code affaire", "code client", "code concessionnaire", "n client", "no client", "numero",
    "n cnc", "cnc", "dealer code",
]
REFERENCE_NAME_WORDS = [
    "affaire", "affaires", "concessionnaire", "client", "nom", "nom client", "raison sociale",
    "societe", "libelle", "dealer", "dealer name",
]

# --- fixed values: cell positions of headerless ERP sheets
BARE_AVOIR = {"erp_date": 3, "customer_code": 5, "customer_name": 6, "sales_order_type": 7, "amount_erp": [10, 9]}
BARE_FACTURE = {
    "erp_date": 0, "customer_code": 3, "customer_name": 4, "amount_erp": [8], "department_code": 9,
    "brand_code": 10, "sales_order_type": 12,
}

# --- fixed values: sizes and limits
SAMPLE_VALUES = 50
SAMPLE_KEYS = 20
TOP_CLIENTS = 20
TOP_CHART = 10
EXCEL_EPOCH = "1899-12-30"
EXCEL_LAST_DAY = 2958465
FEED_YEARS = (1990, 2100)
AMOUNT_FIELD_DIGITS = 13
DEFAULT_TOLERANCE = "1.0"
LOW_RATE = 0.70
HIGH_SCOPE_SHARE = 0.20
NEAR_NAME = 0.80
