"""Fixed values that results must agree on. Text literals, in natural order."""

# Extension lists per category; anything else is OTHER_CATEGORY.
CATEGORIES = {
    "PDF": ["pdf"],
    "Word": ["doc", "docx", "odt"],
    "Excel / Datos": ["xls", "xlsx", "xlsm", "xlsb", "csv", "ods"],
    "PowerPoint": ["ppt", "pptx", "odp"],
    "Imagen": ["jpg", "jpeg", "png", "gif", "bmp", "tif", "tiff", "heic", "webp"],
    "Video": ["mp4", "avi", "mov", "wmv", "mkv", "m4v"],
    "Comprimido": ["zip", "rar", "7z", "tar", "gz", "bz2"],
    "CAD / Planos": ["dwg", "dxf", "dgn", "nwd", "rvt", "ifc"],
    "Email": ["msg", "eml"],
    "Proyecto": ["mpp", "mpt"],
    "Texto / Código": ["txt", "log", "xml", "json", "html", "htm", "md"],
    "Primavera": ["xer", "p6xml"],
}
OTHER_CATEGORY = "Otro"

# Extension -> (label, note) of formats that need a decision.
SPECIAL_FORMATS = {
    "dwg": ("CAD / Planos", "Preview limitado en SPO — visor integrado disponible"),
    "dxf": ("CAD / Planos", "Similar a DWG — intercambio AutoCAD"),
    "heic": ("Imagen", "Sin preview nativo en SPO — considerar convertir a JPG"),
    "xlsm": ("Excel con macros", "Macros no ejecutan en SPO — solo descarga local"),
    "xlsb": ("Excel binario", "Formato binario — sin co-autoría en SPO"),
    "msg": ("Email", "Adjuntos de Outlook — sin preview en SPO"),
    "mp4": ("Video", "Videos pesados — evaluar Azure Blob Storage"),
    "mov": ("Video", "Videos pesados — evaluar Azure Blob Storage"),
    "avi": ("Video", "Videos pesados — evaluar Azure Blob Storage"),
    "zip": ("Comprimido", "ZIPs grandes pueden superar límite SPMT (250 MB)"),
    "rar": ("Comprimido", "RAR no tiene preview en SPO"),
    "7z": ("Comprimido", "7z no tiene preview en SPO"),
    "xer": ("Primavera", "Formato propietario — no indexable por SPO"),
    "nwd": ("CAD / Planos", "Navisworks — requiere visor dedicado"),
}

# Alert texts of the special formats.
ATTENTION_FORMATS = ["heic", "xlsm", "xlsb"]
ATTENTION_ALERT = "Atención requerida"
VIDEO_FORMATS = ["mp4", "mov", "avi"]
VIDEO_ALERT = "Evaluar Azure Blob"
ARCHIVE_FORMATS = ["zip", "rar", "7z"]
ARCHIVE_ALERT = "Verificar límite SPMT"
ARCHIVE_ALERT_GB = 0.25
REVIEW_ALERT = "Revisar"

# Libraries and files that belong to the platform, not to users.
SYSTEM_LIBRARIES = [
    "Site Assets",
    "Activos del sitio",
    "SiteAssets",
    "Form Templates",
    "Style Library",
    "Preservation Hold Library",
    "Pages",
    "Páginas del sitio",
    "Recursos del sitio",
]
SYSTEM_FILES = ["__siteIcon__.png", "__siteIcon__.jpg"]
ROOT_FOLDERS = ["Shared Documents", "Documents", ""]
NO_FOLDER = "(raíz)"

# Site templates, types and classes.
SITE_TYPES = {
    "GROUP": "Team Site (M365 Group)",
    "SITEPAGEPUBLISHING": "Communication Site",
    "STS": "Team Site (clásico)",
    "TEAMCHANNEL": "Canal de Teams",
}
CHANNEL_TYPE = "Canal de Teams"
LEGACY_TEMPLATE_BASES = ["GROUP", "TEAMCHANNEL"]
LEGACY_TEMPLATES = ["GROUP#0", "TEAMCHANNEL#0", "GROUP#1", "TEAMCHANNEL#1"]
LEGACY_LABEL = "Legacy (Teams)"
ROOT_CLASS = "Hub Site (raiz)"
HUB_CLASS = "Hub Site"
SPOKE_CLASS = "Spoke Site (Hub asociado)"
STANDALONE_CLASS = "Sitio independiente"
SUBSITE_CLASS = "Subsitio"
SUBSITE_TYPE_PREFIX = "Subsitio de "
NO_OWNER = "Sin owner"
NO_ID = "00000000-0000-0000-0000-000000000000"
UNLOCKED, NOT_LOCKED, READ_ONLY = "Unlock", "No", "ReadOnly"
YES, NO = "Sí", "No"

# Survey states, recommendations and site status.
OK, NO_FILES, NO_LIBRARIES = "OK", "SinArchivos", "SinBibliotecas"
ERROR_PREFIX, SKIPPED = "Error", "Salteado"
ARCHIVE, ACTIVE, REVIEW = "Archivar", "Activo — revisar destino", "Revisar"
STATUS_ARCHIVE = "CANDIDATO A ARCHIVO"
STATUS_ACTIVE = "ACTIVO POST-MIGRACIÓN"
STATUS_LOW = "ACTIVIDAD BAJA"
LISTED, LISTED_MISSING, GENERATED = "prioritario", "prioritario_faltante", "automatico"
DEFAULT_REPORT_STATE = "gold"

# Tags of the per-site decision list.
TAG_ARCHIVES = "Bloqueante SPMT"
TAG_IMAGES = "Experiencia de usuario"
TAG_MACROS = "Post-migración"
TAG_VIDEO = "Destino alternativo"
TAG_DUPLICATES = "Optimización"
TAG_READY = "Listo para migrar"

# Limits.
ACTIVE_PCT = 30
MIGRATION_LIMIT_BYTES = 250 * 1024 * 1024
FORCE_REFRESH_DAYS = 999
DUPLICATE_REPORT_GB = 0.01
DUPLICATE_DECISION_GB = 1

# File names that look like surveys but hold other outputs.
NOT_SURVEYS = [
    "CONSOLIDADO", "_LOG", "Resumen", "AsignarOwner",
    "Inventario", "Refresh", "Analisis", "Indice",
]

# Health index.
WEIGHTS = {
    "ownership": 0.25,
    "architecture": 0.20,
    "sharing": 0.20,
    "quality": 0.15,
    "lifecycle": 0.10,
    "activity": 0.10,
}
CONTROLLED_SHARING = ["Disabled", "ExistingExternalUserSharingOnly"]
JUNK_FOLDERS = ["SUPERADO", "BORRADORES", "TMP"]
CURATION_FROM, READY_FROM = 36, 70
BASELINE_STAGE, CURATION_STAGE, READY_STAGE = "baseline", "curation", "ready"
